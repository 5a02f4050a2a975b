"""Matching of import rows to products, and the listing upsert.

Identity is decided row by row: barcode, known listing, merge key, new product. A row can match what an earlier row of the
batch made, so the rule is a sequence; it is resolved in rounds of claims, each a few joins over all rows that are open.

A barcode and a listing, once they stand for a product, stand for it for good. A row is settled if no earlier open row can
still give its barcode or its listing a product. Of the settled rows
* those that a barcode or listing matches, and that have nothing the product lacks, are decided at once, however many;
* those that only their merge key can match are decided up to the first row that may give a product this key or take it
  from one: the first of a key makes the product, the others follow it;
* those that bring a brand or size that their product lacks change its key. Of each product the first is decided, if no
  earlier open row may hold or want either key; with it, where the key is taken, the others that want the same one.
Rows that are not settled may come to touch any name that their barcodes and listings lead to, and so hold all rows of
these names behind them. The first open row of all can always be decided. Rounds grow with the keys that change one after
the other under one name, not with the rows of a barcode, listing or name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.operators import graph
from marketloom.session import discard, spread, written


@dataclass
class Imported:
    product: DataFrame
    identifier: DataFrame
    listing: DataFrame
    decision: DataFrame  # ordinal, external_id, product_id, how, outcome, conflict, created, identifier_added, error


def _clean(rows: DataFrame) -> DataFrame:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    gtin = blank("gtin")
    out = rows.withColumns({c: blank(c) for c in ("external_id", "name", "brand", "unit", "category", "product_url")})
    out = out.withColumns({"gtin": F.when(gtin.rlike("^[0-9]{8,14}$"), gtin), "currency": F.when(F.col("price").isNotNull(), F.coalesce(blank(F.upper("currency")), F.lit("RON"))).otherwise(blank(F.upper("currency"))), "available": F.coalesce("available", F.lit(True))})
    bad = F.when(F.col("external_id").isNull() | F.col("name").isNull() | F.col("product_url").isNull(), "incomplete_row")
    bad = F.coalesce(bad, F.when((F.col("price") < 0) | (F.col("price") > 1_000_000), "price_range"), F.when(F.length("name") > 200, "name_length"), F.when(F.length("brand") > 80, "brand_length"), F.when(F.col("quantity").isNull() != F.col("unit").isNull(), "size_complete"), F.when(~F.col("product_url").startswith("https://"), "url_https"))
    key = text.merge_key(F.col("brand"), F.col("name"), F.col("quantity"), F.col("unit"))
    out = out.withColumns({"error": bad, "merge_key": key})
    return out.withColumn("key_name", F.split_part("merge_key", F.lit("|"), F.lit(2)))


def _registers(rows: DataFrame) -> DataFrame | None:
    """(ordinal, register): rows that share barcodes or listings, directly or through others; None where none do."""

    def shared(c: str) -> DataFrame:
        first = written(rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("ordinal").alias("b"), F.max("ordinal").alias("last")).where("b < last").select(c, "b"))
        return rows.join(first, c).select(F.col("ordinal").alias("a"), "b").where("a <> b")

    edges = written(shared("external_id").unionByName(shared("gtin")))
    return None if edges.isEmpty() else graph.components(edges).select(F.col("node").alias("ordinal"), F.col("component").alias("register"))


@dataclass
class _Claims:
    """What stands so far: products (product_id, key, of_name, branded, sized), and what barcodes and listings stand for."""

    products: DataFrame
    gtins: DataFrame
    shown: DataFrame


def _settled(rows: DataFrame, now: _Claims) -> DataFrame:
    """rows with what they find by barcode and listing, and kind: wait, key, fill or same."""
    out = rows.join(now.shown.select("external_id", F.col("product_id").alias("by_listing")), "external_id", "left").join(now.gtins.select("gtin", F.col("product_id").alias("by_gtin")), "gtin", "left")
    repeated = rows.where("register is not null")
    first = lambda c: written(repeated.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("ordinal").alias(f"first_{c}")))
    out = out.join(first("external_id"), "external_id", "left").join(first("gtin"), "gtin", "left")
    is_first = lambda c: F.coalesce(F.col("ordinal") <= F.col(f"first_{c}"), F.lit(True))
    settled = (F.col("by_listing").isNotNull() | is_first("external_id")) & (F.col("gtin").isNull() | F.col("by_gtin").isNotNull() | is_first("gtin"))
    conflict = F.coalesce(F.col("by_gtin") != F.col("by_listing"), F.lit(False))
    out = out.withColumns({"settled": settled, "conflict": conflict, "found": F.when(conflict, F.col("by_listing")).otherwise(F.coalesce("by_gtin", "by_listing"))})
    out = out.join(now.products.withColumnRenamed("product_id", "found"), "found", "left")
    out = out.withColumns({"fills_brand": ~F.col("branded") & F.col("has_brand"), "fills_size": ~F.col("sized") & F.col("has_size")})
    part = lambda n: F.split_part("key", F.lit("|"), F.lit(n))
    new_key = F.concat_ws("|", F.when(F.col("fills_brand"), F.col("key_brand")).otherwise(part(1)), "of_name", F.when(F.col("fills_size"), F.col("key_size")).otherwise(part(3)))
    kind = F.when(~F.col("settled"), "wait").when(F.col("found").isNull(), "key").when(F.col("fills_brand") | F.col("fills_size"), "fill").otherwise("same")
    return out.withColumns({"new_key": new_key, "kind": kind}).drop("first_external_id", "first_gtin", "settled")


def _round(open_: DataFrame, now: _Claims, retailer: str) -> tuple[DataFrame, _Claims]:
    """The rows that can be decided, with their decisions, and what stands after them."""
    base = written(_settled(open_, now))
    kinds = {r["kind"] for r in base.select("kind").distinct().collect()}
    of = lambda kind: base.where(F.col("kind") == kind)
    earliest = lambda df, *by: df.groupBy(*by).agg(F.min("ordinal").alias("since"))
    own_id = lambda c: F.concat(F.lit(f"{retailer}:"), F.col(c))
    how = F.when(F.col("conflict"), "listing").when(F.col("by_gtin").isNotNull(), "gtin").otherwise("listing")
    decided = [of("same").select("*", F.col("found").alias("product_id"), how.alias("how"), F.lit(False).alias("created"), F.lit(None).cast("string").alias("error"))]
    # Names held by rows that wait, and by rows that may change a product's key after another one.
    names = base.select("register", F.col("key_name").alias("name")).unionByName(base.where("of_name is not null").select("register", F.col("of_name").alias("name")))
    held = names.where("register is not null").distinct().join(earliest(of("wait"), "register"), "register").select("name", "since")
    fills, first = of("fill"), of("fill").groupBy("found").agg(F.min(F.struct("ordinal", "new_key")).alias("f"))
    if "fill" in kinds:
        first = written(first)
        fills = written(fills.join(first, "found"))
        held = held.unionByName(fills.where("new_key <> f.new_key").select(F.col("of_name").alias("name"), F.col("ordinal").alias("since")))
    held = written(held.groupBy("name").agg(F.min("since").alias("held_since")))
    if "fill" in kinds:
        leads = fills.where("ordinal = f.ordinal")
        wanted = written(leads.select(F.explode(F.array("key", "new_key")).alias("k"), F.struct("ordinal", "found").alias("w")).groupBy("k").agg(F.min("w").alias("w")))
        asked = written(earliest(of("key"), "merge_key"))
        since = lambda c, name: asked.select(F.col("merge_key").alias(c), F.col("since").alias(name))
        taken_by = now.products.select(F.col("key").alias("new_key"), F.col("product_id").alias("taken_by"))
        rows = fills.where("new_key = f.new_key").join(held.withColumnRenamed("name", "of_name"), "of_name", "left").join(wanted.withColumnRenamed("k", "new_key"), "new_key", "left")
        rows = rows.join(since("new_key", "asked_new"), "new_key", "left").join(since("key", "asked_old"), "key", "left").join(taken_by, "new_key", "left")
        rows = rows.join(first.select(F.col("found").alias("taken_by"), F.lit(True).alias("moving")), "taken_by", "left")
        before = lambda c: F.col(c).isNull() | (F.col("ordinal") < F.col(c))
        free = before("held_since") & before("asked_new") & before("asked_old") & ((F.col("w.found") == F.col("found")) | before("w.ordinal"))
        taken = F.coalesce(F.col("taken_by") != F.col("found"), F.lit(False))
        rows = rows.where(free & ((F.col("ordinal") == F.col("f.ordinal")) | (taken & F.col("moving").isNull())))
        decided.append(rows.select(*base.columns, F.col("found").alias("product_id"), how.alias("how"), F.lit(False).alias("created"), F.when(taken, "merge_key_taken").alias("error")))
    if "key" in kinds:
        rows = of("key").join(held.withColumnRenamed("name", "key_name"), "key_name", "left").where("held_since is null or ordinal < held_since")
        if "fill" in kinds:
            rows = rows.join(wanted.select(F.col("k").alias("merge_key"), "w"), "merge_key", "left").where("w is null or ordinal < w.ordinal").drop("w")
        rows = written(rows.join(now.products.select(F.col("key").alias("merge_key"), F.col("product_id").alias("by_key")), "merge_key", "left"))
        made = written(rows.where("by_key is null and not exists").groupBy("merge_key").agg(F.min("ordinal").alias("made_at"), F.min_by("external_id", "ordinal").alias("maker")))
        rows = rows.join(made, "merge_key", "left")
        creates = F.coalesce(F.col("ordinal") == F.col("made_at"), F.lit(False))
        product = F.coalesce("by_key", F.when(F.col("ordinal") >= F.col("made_at"), own_id("maker")))
        follows = F.col("by_key").isNotNull() | F.coalesce(F.col("ordinal") > F.col("made_at"), F.lit(False))
        decided.append(rows.select(*base.columns, product.alias("product_id"), F.when(follows, "key").otherwise("new").alias("how"), creates.alias("created"), F.when(product.isNull(), "product_exists").alias("error")))
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    fine = F.col("error").isNull()
    adds = fine & ~F.col("conflict") & F.col("by_gtin").isNull()
    out = written(out.withColumns({"product_id": F.when(fine, F.col("product_id")), "conflict": F.col("conflict") & fine, "add_gtin": F.when(adds, F.col("gtin"))}))
    # What follows for products: new ones, and keys, brands and sizes of those that were filled.
    ok = out.where("error is null")
    moved = written(ok.where("kind <> 'same'").groupBy("product_id").agg(
        F.bool_or("has_brand").alias("more_brand"), F.bool_or("has_size").alias("more_size"), F.max(F.when(F.col("kind") == "fill", F.col("new_key"))).alias("moved_to"),
        F.max(F.when(F.col("created"), F.struct("merge_key", "key_name"))).alias("made"),
    ))
    new = lambda c, *options: F.coalesce(*options).alias(c)
    products = now.products.join(moved, "product_id", "full_outer").select(
        "product_id", new("key", "moved_to", "key", "made.merge_key"), new("of_name", "of_name", "made.key_name"),
        (F.coalesce("branded", F.lit(False)) | F.coalesce("more_brand", F.lit(False))).alias("branded"), (F.coalesce("sized", F.lit(False)) | F.coalesce("more_size", F.lit(False))).alias("sized"),
    )
    shown = now.shown.unionByName(ok.where("by_listing is null").select("external_id", "product_id"))
    gtins = now.gtins.unionByName(ok.where("add_gtin is not null").select(F.col("add_gtin").alias("gtin"), "product_id"))
    after = _Claims(written(products), written(gtins), written(shown))
    discard(base, held, moved)
    return out.select("ordinal", "product_id", "how", "conflict", "created", "add_gtin", "error"), after


def resolve(rows: DataFrame, retailer: str, products: DataFrame, identifiers: DataFrame, listings: DataFrame) -> DataFrame:
    """A decision for each row. rows: ordinal and the import row; products: with merge_key; listings: of this retailer."""
    part = lambda c, n: F.split_part(c, F.lit("|"), F.lit(n))
    # Keys are much work for a row, and a file of a million rows may be read by one task: rows are dealt out first.
    ready = written(_clean(spread(rows)).withColumns({"key_brand": part("merge_key", 1), "key_size": part("merge_key", 3)}))
    good = ready.where("error is null")
    codes = identifiers.where("identifier_type = 'gtin'").select(F.col("identifier_value").alias("gtin"), "product_id")
    shown = written(listings.select("external_id", "product_id").join(good.select("external_id").distinct(), "external_id", "left_semi"))
    gtins = written(codes.join(good.select("gtin").distinct(), "gtin", "left_semi"))
    # Products that rows can reach: those that stand behind a barcode or listing, and all of the names in question.
    every = products.select("product_id", F.col("merge_key").alias("key"), part("merge_key", 2).alias("of_name"), F.col("brand").isNotNull().alias("branded"), F.col("quantity").isNotNull().alias("sized"))
    behind = shown.select("product_id").unionByName(gtins.select("product_id")).distinct()
    names = good.select(F.col("key_name").alias("of_name")).unionByName(every.join(behind, "product_id", "left_semi").select("of_name")).distinct()
    now = _Claims(written(every.join(names, "of_name", "left_semi")), gtins, shown)
    exists = products.select(F.col("product_id").alias("own_id"), F.lit(True).alias("exists"))
    todo = good.withColumn("own_id", F.concat(F.lit(f"{retailer}:"), F.col("external_id"))).join(exists, "own_id", "left")
    todo = todo.select("ordinal", "external_id", "gtin", "merge_key", "key_brand", "key_name", "key_size", F.col("brand").isNotNull().alias("has_brand"), F.col("unit").isNotNull().alias("has_size"), F.coalesce("exists", F.lit(False)).alias("exists"))
    registers = _registers(good)
    open_ = written(todo.withColumn("register", F.lit(None).cast("long")) if registers is None else todo.join(registers, "ordinal", "left"))
    null = F.lit(None).cast("string")
    decisions = ready.where("error is not null").select("ordinal", null.alias("product_id"), null.alias("how"), F.lit(False).alias("conflict"), F.lit(False).alias("created"), null.alias("add_gtin"), "error")
    while not open_.isEmpty():
        before = now
        done, now = _round(open_, now, retailer)
        decisions = decisions.unionByName(done)
        open_, old = written(open_.join(done.select("ordinal"), "ordinal", "left_anti")), open_
        discard(old, before.products, before.gtins, before.shown)
    return written(ready.drop("error").join(decisions, "ordinal").select("ordinal", "external_id", "product_id", "how", "conflict", "created", "add_gtin", "error", "brand", "quantity", "unit", "category", "name"))


_COMPARED = ["product_id", "retailer_name", "retailer_brand", "retailer_category", "price", "currency", "available", "product_url"]


def observed(rows: DataFrame, decisions: DataFrame, listings: DataFrame) -> DataFrame:
    """A row for each accepted import row, in the listing's own order: what the listing was and is, and the outcome
    (inserted, updated, unchanged). A second row for a listing is held against the first."""
    ok = decisions.where("error is null").select("ordinal", "external_id", "product_id")
    new = _clean(rows).where("error is null").drop("external_id").join(ok, "ordinal")
    now = F.struct("product_id", F.col("name").alias("retailer_name"), F.col("brand").alias("retailer_brand"), F.col("category").alias("retailer_category"), "price", "currency", "available", "product_url")
    old = listings.select("external_id", F.struct(*_COMPARED).alias("before"))
    order = Window.partitionBy("external_id").orderBy("ordinal")
    both = new.select("ordinal", "external_id", now.alias("now")).join(old, "external_id", "left")
    both = both.withColumn("was", F.coalesce(F.lag("now").over(order), "before"))
    same = F.lit(True)
    for c in _COMPARED:
        same = same & F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}"))
    outcome = F.when(F.col("was").isNull(), "inserted").when(same, "unchanged").otherwise("updated")
    moved = F.when(F.col("was").isNull(), F.col("now.price").isNotNull()).otherwise(~F.col("was.price").eqNullSafe(F.col("now.price")))
    return both.select("ordinal", "external_id", "now", outcome.alias("outcome"), moved.alias("moved"), F.when(F.col("was").isNotNull() & moved, F.struct(F.col("was.price").alias("price"))).alias("left"))


def upsert(seen: DataFrame, listings: DataFrame, retailer: str, started_at) -> DataFrame:
    """The retailer's listings after the batch. seen: from observed(). Every stamp is the start of the run."""
    last = seen.groupBy("external_id").agg(F.max_by("now", "ordinal").alias("now"), F.bool_or("moved").alias("moved"), F.max_by("left", F.when(F.col("left").isNotNull(), F.col("ordinal"))).alias("left"))
    both = listings.withColumn("known", F.lit(True)).join(last, "external_id", "full_outer")
    is_seen, known, stamp = F.col("now").isNotNull(), F.coalesce("known", F.lit(False)), F.lit(started_at).cast("timestamp")
    keep = lambda c: F.when(is_seen, F.col(f"now.{c}")).otherwise(F.col(c)).alias(c)
    return both.select(
        keep("product_id"), F.lit(retailer).alias("retailer"), "external_id", *map(keep, _COMPARED[1:]),
        F.when(F.col("left").isNotNull(), F.col("left.price")).otherwise(F.col("previous_price")).alias("previous_price"),
        F.when(F.coalesce("moved", F.lit(False)), stamp).otherwise(F.col("last_price_at")).alias("last_price_at"),
        F.when(known, F.col("first_seen_at")).otherwise(stamp).alias("first_seen_at"), F.when(is_seen, stamp).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
    )


def products_after(products: DataFrame, decisions: DataFrame, started_at) -> DataFrame:
    """Products with blanks filled from the first row that can, and new ones; never renamed. merge_key follows."""
    ok = decisions.where("error is null")
    first = lambda c, when: F.min_by(c, F.when(when, F.col("ordinal")))
    fills = ok.groupBy("product_id").agg(
        first("brand", F.col("brand").isNotNull()).alias("f_brand"), first(F.struct("quantity", "unit"), F.col("unit").isNotNull()).alias("f_size"), first("category", F.col("category").isNotNull()).alias("f_category"),
        F.min_by(F.struct("name"), F.when(F.col("created"), F.col("ordinal"))).alias("made"),
    )
    both = products.withColumn("old", F.lit(True)).join(fills, "product_id", "full_outer")
    sized = F.col("quantity").isNull() & F.col("f_size").isNotNull()
    out = both.select(
        "product_id", F.coalesce("canonical_name", "made.name").alias("canonical_name"), F.coalesce("brand", "f_brand").alias("brand"),
        F.when(sized, F.col("f_size.quantity")).otherwise(F.col("quantity")).alias("quantity"), F.when(sized, F.col("f_size.unit")).otherwise(F.col("quantity_unit")).alias("quantity_unit"),
        F.coalesce("category", "f_category").alias("category"), F.coalesce("add_count", F.lit(0)).cast("long").alias("add_count"), F.coalesce("first_seen_at", F.lit(started_at).cast("timestamp")).alias("first_seen_at"),
    )
    return out.withColumn("merge_key", text.merge_key(F.col("brand"), F.col("canonical_name"), F.col("quantity"), F.col("quantity_unit")))


def derived(products: DataFrame, listings: DataFrame) -> DataFrame:
    """products with what follows from them and their listings: merge_key, listing_count, popularity, search_blob and the
    folded names. A product is seen first when its first listing was, unless it says so itself."""
    # Shops often use one name: each name of a product is folded once.
    named = listings.groupBy("product_id", "retailer_name").agg(F.count("*").alias("n"), F.min("first_seen_at").alias("first_seen_at"))
    names = named.groupBy("product_id").agg(F.sum("n").alias("listing_count"), F.array_join(F.array_sort(F.collect_set(text.fold(F.col("retailer_name")))), " ").alias("names"), F.min("first_seen_at").alias("first_listed_at"))
    ours = ["listing_count", "popularity", "first_seen_at", "merge_key", "search_blob", "name_folded", "brand_folded"]
    plain = [c for c in products.columns if c not in ours]
    first = F.coalesce("first_seen_at", "first_listed_at") if "first_seen_at" in products.columns else F.col("first_listed_at")
    out = products.select(*plain, *[c for c in ("first_seen_at",) if c in products.columns]).join(names, "product_id", "left").withColumn("listing_count", F.coalesce("listing_count", F.lit(0)))
    blob = F.left(text.squeeze(F.concat_ws(" ", text.fold(F.col("canonical_name")), text.fold(F.col("brand")), F.coalesce("names", F.lit("")))), F.lit(1000))
    return out.select(
        *plain, "listing_count", (F.col("add_count") + 5 * F.col("listing_count")).alias("popularity"), first.alias("first_seen_at"),
        text.merge_key(F.col("brand"), F.col("canonical_name"), F.col("quantity"), F.col("quantity_unit")).alias("merge_key"), blob.alias("search_blob"),
        text.fold(F.col("canonical_name")).alias("name_folded"), text.fold(F.col("brand")).alias("brand_folded"),
    )


def searchable(imported: Imported) -> DataFrame:
    """The products of an import as search, lookups and reports take them."""
    return derived(imported.product, imported.listing)


def import_rows(rows: DataFrame, retailer: str, started_at, products: DataFrame, identifiers: DataFrame, listings: DataFrame) -> Imported:
    """One batch of one retailer. products: with merge_key; listings: all retailers'. Given tables are not changed."""
    own = listings.where(F.col("retailer") == retailer)
    decisions = resolve(rows, retailer, products, identifiers, own)
    seen = written(observed(rows, decisions, own))
    after = written(upsert(seen, own, retailer, started_at))
    added = decisions.where("error is null and add_gtin is not null").select("product_id", F.lit("gtin").alias("identifier_type"), F.col("add_gtin").alias("identifier_value"), F.lit(retailer).alias("source"))
    goods = written(products_after(products, decisions, started_at))
    outcome = decisions.join(seen.select("ordinal", "outcome"), "ordinal", "left")
    return Imported(goods, identifiers.unionByName(added), listings.where(F.col("retailer") != retailer).unionByName(after), outcome)


def import_counters(imported: Imported) -> DataFrame:
    """inserted, updated, unchanged, products_created, identifiers_added, conflicts, errors of a batch, in one row."""
    return imported.decision.agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "updated", "unchanged")], F.count_if("created").alias("products_created"),
        F.count_if(F.col("add_gtin").isNotNull()).alias("identifiers_added"), F.count_if("conflict").alias("conflicts"), F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


def first_errors(imported: Imported, most: int = 25) -> DataFrame:
    return imported.decision.where("error is not null").orderBy("ordinal").limit(most).select("external_id", F.left("name", F.lit(80)).alias("name"), "error")
