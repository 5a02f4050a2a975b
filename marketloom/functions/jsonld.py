"""Products and breadcrumbs out of the JSON-LD of captured pages, as Spark expressions over VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text

# Where pages keep JSON-LD, and the signs that attributes escape.
_SCRIPT = r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""
_ATTRIBUTE = r"""(?is)<script\b(?=[^>]*application/ld\+json)[^>]*?\schildren="([^"]*)"[^>]*>"""


def _unescaped(value: Column) -> Column:
    for sign, meant in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):  # & last
        value = F.replace(value, F.lit(sign), F.lit(meant))
    return value


def blocks(html: Column) -> Column:
    """Array of the page's JSON-LD blocks as texts, script bodies first; blocks that are no JSON drop out alone."""
    bodies = F.regexp_extract_all(html, F.lit(_SCRIPT), F.lit(1))
    attributes = F.transform(F.regexp_extract_all(html, F.lit(_ATTRIBUTE), F.lit(1)), _unescaped)
    found = F.transform(F.concat(bodies, attributes), lambda b: F.trim(b))
    return F.filter(found, lambda b: F.try_parse_json(b).isNotNull() & (b != ""))


def _get(node: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(node, path, kind)


def _is_array(node: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(node, path, "variant")).startswith("ARRAY"), F.lit(False))


def _scalar(node: Column, path: str) -> Column:
    """Text of a string or number; null for objects and arrays."""
    value = F.try_variant_get(node, path, "variant")
    kind = F.schema_of_variant(value)
    return F.nullif(F.trim(F.when(~kind.startswith("ARRAY") & ~kind.startswith("OBJECT"), _get(node, path))), F.lit(""))


def nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with node (variant) and ord: blocks, members of arrays and of @graph at any depth, nearest to the top first."""
    none = F.array().cast("array<variant>")
    members = lambda v, path: F.coalesce(_get(v, path, "array<variant>"), none)
    below = lambda level: F.flatten(F.transform(level, lambda v: F.concat(members(v, "$"), members(v, "$['@graph']"))))
    read = pages.withColumn("__blocks", blocks(F.col(html)))
    # Each step down opens an array, so that there are no more levels than the blocks have brackets.
    deepest = F.regexp_count(F.array_join("__blocks", " "), F.lit(r"\["))
    start = F.struct(none.alias("found"), F.transform("__blocks", F.try_parse_json).alias("level"))
    step = lambda acc, _: F.struct(F.concat(acc["found"], acc["level"]).alias("found"), below(acc["level"]).alias("level"))
    every = F.aggregate(F.sequence(F.lit(0), deepest), start, step, lambda acc: F.concat(acc["found"], acc["level"]))
    return read.select(*pages.columns, F.posexplode(every).alias("ord", "node"))


def products(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """The first Product of each page that has one: name, sku, gtin, brand, image, description, price, currency, availability, url."""
    found = nodes(pages.select(key, html), html)
    kind = F.when(_is_array(F.col("node"), "$['@type']"), F.array_contains(_get(F.col("node"), "$['@type']", "array<string>"), "Product")).otherwise(_get(F.col("node"), "$['@type']") == "Product")
    # A variant can't be compared: the first is chosen by its place, and the node goes along as text.
    first = found.where(kind).groupBy(key).agg(F.min_by(F.to_json("node"), "ord").alias("text"))
    return fields(first.withColumn("node", F.try_parse_json("text"))).select(key, *_FIELDS)


_FIELDS = ["name", "sku", "gtin", "brand", "image", "description", "price", "currency", "availability", "url"]


def _number(node: Column, path: str) -> Column:
    """A number as it is; of a text, what parse_price reads."""
    value = F.try_variant_get(node, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", text.parse_price(_get(node, path))).otherwise(_get(node, path, "double"))


def fields(found: DataFrame) -> DataFrame:
    """found (node: a Product) with the columns of _FIELDS. A field may be a text, a number, an object or an array of
    these: an array of offers gives the first that names a price that can be read, directly or in its specification, else
    the first."""
    node, offer, spec = F.col("node"), F.col("__offer"), F.col("__spec")
    among = lambda o: F.filter(F.coalesce(_get(o, "$.priceSpecification", "array<variant>"), F.array().cast("array<variant>")), lambda s: _number(s, "$.price").isNotNull())
    any_price = lambda o: F.coalesce(_number(o, "$.price"), _number(o, "$.priceSpecification.price"), F.when(F.size(among(o)) > 0, F.lit(0.0)))
    first_of = lambda many, price: F.try_element_at(F.filter(F.col(many), lambda o: price(o).isNotNull()), F.lit(1))
    out = found.withColumns({"__offers": _get(node, "$.offers", "array<variant>"), "__single": F.try_variant_get(node, "$.offers", "variant")})
    out = out.withColumn("__offer", F.when(F.col("__offers").isNull(), F.col("__single")).otherwise(F.coalesce(first_of("__offers", any_price), F.try_element_at("__offers", F.lit(1)))))
    out = out.withColumns({"__specs": _get(offer, "$.priceSpecification", "array<variant>"), "__one": F.try_variant_get(offer, "$.priceSpecification", "variant")})
    out = out.withColumn("__spec", F.when(F.col("__specs").isNull(), F.col("__one")).otherwise(first_of("__specs", lambda s: _number(s, "$.price"))))
    # Plain lookups first, all in one step; the choices between them after that.
    raw = {f"__{c}": _get(node, f"$.{c}") for c in ("name", "sku", "productID", "mpn", "url", "description")}
    for c in ("gtin13", "gtin", "gtin14", "gtin12", "gtin8", "image"):
        raw |= {f"__{c}": _get(node, f"$.{c}"), f"__{c}0": _get(node, f"$.{c}[0]")}
    raw |= {"__brand": F.coalesce(_get(node, "$.brand[0].name"), _get(node, "$.brand[0]"), _get(node, "$.brand.name"), _get(node, "$.brand"))}
    raw |= {"__price": _number(offer, "$.price"), "__spec_price": _number(spec, "$.price"), "__currency": _get(offer, "$.priceCurrency"), "__spec_currency": _get(spec, "$.priceCurrency"), "__stock": F.coalesce(_get(offer, "$.availability['@id']"), _get(offer, "$.availability")), "__offer_url": _get(offer, "$.url")}
    out = out.withColumns(raw)
    plain = lambda c: F.nullif(F.trim(F.when(~F.col(c).rlike(r"^\s*[\[{]"), F.col(c))), F.lit(""))
    either = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"{c}0")), F.lit("")), plain(c))
    return out.withColumns({
        "name": plain("__name"), "sku": F.coalesce(plain("__sku"), plain("__productID"), plain("__mpn")), "gtin": F.coalesce(*[either(f"__{c}") for c in ("gtin13", "gtin", "gtin14", "gtin12", "gtin8")]), "brand": plain("__brand"),
        "image": either("__image"), "description": plain("__description"), "price": F.coalesce("__price", "__spec_price"), "currency": F.coalesce(plain("__currency"), plain("__spec_currency")), "availability": plain("__stock"), "url": F.coalesce(plain("__url"), plain("__offer_url")),
    })


def breadcrumbs(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """links: the hrefs of each page's breadcrumb lists, in order of position."""
    found = nodes(pages.select(key, html), html).where(_get(F.col("node"), "$['@type']") == "BreadcrumbList")
    items = found.select(key, "ord", F.posexplode(_get(F.col("node"), "$.itemListElement", "array<variant>")).alias("k", "item"))
    href = F.coalesce(_scalar(F.col("item"), "$.item"), _scalar(F.col("item"), "$.item['@id']"))
    placed = items.select(key, F.struct("ord", F.coalesce(_get(F.col("item"), "$.position", "double"), F.lit(0.0)).alias("position"), "k", href.alias("href")).alias("x")).where("x.href is not null")
    return placed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["href"]).alias("links"))
