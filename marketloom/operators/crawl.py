"""What a capture covered: page sequences, departments, allow and deny rules, robots rules, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import written


def until_repeat(pages: DataFrame, most: int = 400) -> DataFrame:
    """Pages (department, page, ids) before the first that is empty or repeats the page before it, most at most."""
    order = Window.partitionBy("department").orderBy("page")
    ends = (F.size("ids") == 0) | F.coalesce(F.col("ids") == F.lag("ids").over(order), F.lit(False))
    marked = pages.withColumn("ends", ends.cast("int"))
    so_far = F.max("ends").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumns({"over": so_far, "nth": F.row_number().over(order)}).where((F.col("over") == 0) & (F.col("nth") <= most)).drop("ends", "over", "nth")


def narrowest_department(rows: DataFrame) -> DataFrame:
    """Each product (external_id) once, from the department with the longest URL; then by department, page and place."""
    first = F.min_by(F.struct(*[c for c in rows.columns if c != "external_id"]), F.struct(-F.length("department"), "department", "page", "pos"))
    return rows.groupBy("external_id").agg(first.alias("x")).select("external_id", "x.*")


def category_paths(products: DataFrame, pattern: str = r"^/(\d+/)+$") -> DataFrame:
    """The distinct id paths that products carry."""
    return products.select(F.explode("category_ids").alias("path")).where(F.regexp_like("path", F.lit(pattern))).distinct()


def tree_paths(files: DataFrame, body: str = "body") -> DataFrame:
    """The id paths (/1/12/) of category trees (arrays of nodes with id and children) at any depth, each once. A node
    without a number for an id goes, and with it all that stands below it."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    kind = F.schema_of_variant(get(F.col("node"), "$.id", "variant"))
    placed = lambda df, head, nodes: df.select(head.alias("head"), F.explode(nodes).alias("node")).where(kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")))
    tree = files.select(F.try_parse_json(body).alias("tree")).where("tree is not null")
    path = F.concat("head", get(F.col("node"), "$.id", "string"), F.lit("/"))
    # A level at a time, nodes as rows: as many steps as the deepest tree has levels.
    level = written(placed(tree, F.lit("/"), get(F.col("tree"), "$", "array<variant>")))
    found = level.select(path.alias("path"))
    while not level.isEmpty():
        level = written(placed(level, path, get(F.col("node"), "$.children", "array<variant>")))
        found = found.unionByName(level.select(path.alias("path")))
    return found.distinct()


def on_numbered_shelf(path: Column, primary: Column, sections: list[str], carved_out: list[str], labels: list[str], refused: list[str]) -> Column:
    """Whether a page's shelf (path of ids, primary label; see captures.page_shelf) is wanted: by the section's number
    (second of the path) without the aisles carved out (third), by the label where there is no section. Refused labels
    and pages without a shelf are not."""
    section, aisle = F.try_element_at(path, F.lit(2)), F.try_element_at(path, F.lit(3))
    by_number = section.isin(sections) & ~F.coalesce(aisle.isin(carved_out), F.lit(False))
    return F.when(F.coalesce(primary.isin(refused), F.lit(False)), False).when(section.isNotNull(), by_number).otherwise(F.coalesce(primary.isin(labels), F.lit(False)))


def deepest(paths: Column) -> Column:
    """Paths of which none of the others is a continuation."""
    return F.filter(paths, lambda p: ~F.exists(paths, lambda q: (q != p) & F.startswith(q, p)))


def in_allowlist(paths: Column, allowed: list[str], carved_out: list[str] = ()) -> Column:
    """Whether any deepest path is on the list and not carved out."""
    starts = lambda p, heads: F.coalesce(*[F.when(F.startswith(p, F.lit(h)), F.lit(True)) for h in heads], F.lit(False)) if heads else F.lit(False)
    return F.exists(deepest(paths), lambda p: starts(p, allowed) & ~starts(p, list(carved_out)))


def on_shelf(products: DataFrame, shelves: DataFrame, carved_out: str | None = None) -> DataFrame:
    """Products whose (retailer, shelf) is on the list; carved_out: pattern of shelves that aren't after all."""
    kept = products.join(shelves.select("retailer", "shelf").distinct(), ["retailer", "shelf"], "left_semi")
    return kept if carved_out is None else kept.where(~F.regexp_like("shelf", F.lit(carved_out)))


def departments(urls: DataFrame, allowed: list[str], carved_out: list[str]) -> DataFrame:
    """Department urls (url, path) on the list, without those carved out and without parents of one carved out."""
    rule = lambda heads, f: F.coalesce(*[F.when(f(F.lit(h)), F.lit(True)) for h in heads], F.lit(False)) if heads else F.lit(False)
    own = rule(allowed, lambda h: F.col("path").startswith(h))
    out = rule(carved_out, lambda h: F.col("path").startswith(h)) | rule(carved_out, lambda h: F.startswith(h, F.col("path")))
    return urls.where(own & ~out)


def denied(urls: DataFrame, patterns: list[str]) -> DataFrame:
    """urls with denied: skipped unread, but covered."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.regexp_like("url", F.lit(p))
    return urls.withColumn("denied", hit)


def coverage(advertised: DataFrame, seen: DataFrame, key: str = "external_id", least: float = 0.95) -> DataFrame:
    """One row: advertised, seen, ratio, authoritative (ratio of at least least)."""
    both = advertised.select(key).distinct().join(seen.select(key).distinct().withColumn("seen", F.lit(True)), key, "left")
    n = both.agg(F.count("*").alias("advertised"), F.count_if("seen").alias("seen"))
    return n.withColumn("ratio", F.when(F.col("advertised") > 0, F.col("seen") / F.col("advertised"))).withColumn("authoritative", F.coalesce(F.col("ratio") >= least, F.lit(False)))


def outside(seen: DataFrame, kept: DataFrame, key: str = "external_id") -> DataFrame:
    """Ids seen that were not kept."""
    return seen.select(key).distinct().join(kept.select(key), key, "left_anti")


def _pattern(rule: Column) -> Column:
    """A robots path as a regular expression: * is anything, a last $ is the end, all else is itself."""
    anchored = F.endswith(rule, F.lit("$"))
    body = F.when(anchored, F.left(rule, F.length(rule) - 1)).otherwise(rule)
    quoted = F.concat(F.lit(r"\Q"), F.replace(body, F.lit("*"), F.lit(r"\E.*\Q")), F.lit(r"\E"))
    return F.concat(F.lit("^"), quoted, F.when(anchored, F.lit("$")).otherwise(F.lit("")))


def robots_rules(files: DataFrame, agents: list[str]) -> DataFrame:
    """(host, allow, path) of the groups for * and for the given agents in robots files (host, body).

    A group is a run of agent lines and the rules up to the next one; any other field ends the run of agent lines, but for
    sitemap, which stands outside of groups. Lines without a colon don't count; lines are told apart by their place.
    """
    line = files.select("host", F.posexplode(F.split("body", r"\r?\n")).alias("n", "line")).withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    field, value = F.lower(F.trim(F.split_part("line", F.lit(":"), F.lit(1)))), F.trim(F.regexp_extract("line", r"^[^:]*:(.*)$", 1))
    parsed = line.select("host", "n", "line", field.alias("field"), value.alias("value")).where(F.contains("line", F.lit(":")) & (F.col("field") != "sitemap"))
    order = Window.partitionBy("host").orderBy("n")
    agent = F.col("field") == "user-agent"
    opens = agent & ~F.coalesce(F.lag("field").over(order) == "user-agent", F.lit(False))
    grouped = parsed.withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(order))
    ours = grouped.where(agent & F.lower("value").isin("*", *[a.lower() for a in agents])).select("host", "group").distinct()
    rules = grouped.where(F.col("field").isin("allow", "disallow") & (F.col("value") != "")).join(ours, ["host", "group"], "left_semi")
    return rules.select("host", (F.col("field") == "allow").alias("allow"), F.col("value").alias("path"))


def allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls with allowed: by the longest rule that matches, allow before disallow; true where none does."""
    path = F.concat(F.coalesce(F.nullif(F.parse_url("url", F.lit("PATH")), F.lit("")), F.lit("/")), F.coalesce(F.concat(F.lit("?"), F.parse_url("url", F.lit("QUERY"))), F.lit("")))
    asked = urls.select("url").distinct().withColumns({"host": F.parse_url("url", F.lit("HOST")), "target": path})
    hits = asked.join(rules, "host").where(F.regexp_like("target", _pattern(F.col("path"))))
    best = hits.groupBy("url").agg(F.max_by("allow", F.struct(F.length("path"), "allow")).alias("allowed"))
    return urls.join(best, "url", "left").withColumn("allowed", F.coalesce("allowed", F.lit(True)))


def by_mode(urls: DataFrame, mode: str) -> DataFrame:
    """Department urls (grocery) of a run's mode: all, groceries alone, or removals (all that are no groceries)."""
    if mode not in ("all", "groceries", "removals"):
        raise ValueError(f"unknown mode: {mode}")
    return urls if mode == "all" else urls.where(F.col("grocery") == F.lit(mode == "groceries"))
