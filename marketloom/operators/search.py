"""Ranked search, barcode lookup and badge lookup. Each takes a DataFrame of requests, so that many are one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.session import discard, written

# Points of the ranks, best first, and of the bonuses.
RANKS = {"name_exact": 100, "name_prefix": 80, "brand_exact": 70, "name_tokens": 60, "brand_prefix": 50, "blob_tokens": 30, "blob_substring": 20, "fuzzy": 5}
BONUS_AVAILABLE, BONUS_SHOPS, BONUS_QUANTITY, FUZZY, TOKENS = 5, 3, 1, 0.42, 6


def weights(spark) -> DataFrame:
    rows = [*RANKS.items(), ("bonus_available", BONUS_AVAILABLE), ("bonus_multi_retailer", BONUS_SHOPS), ("bonus_quantity", BONUS_QUANTITY)]
    return spark.createDataFrame(rows, "name string, points int")


def tokenised(requests: DataFrame) -> DataFrame:
    """requests with query (folded) and tokens (the first six words); those of under two characters go."""
    folded = requests.withColumn("query", text.fold(F.col("query"))).where(F.length("query") >= 2)
    return folded.withColumn("tokens", F.filter(F.slice(F.split("query", " "), 1, TOKENS), lambda t: t != ""))


def grams(words: Column) -> Column:
    """All distinct pieces of one, two and three characters of an array of words."""
    pieces = lambda w, n: F.when(F.length(w) >= n, F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.concat(pieces(w, 1), pieces(w, 2), pieces(w, 3)))))


def texts_of(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text_id, search_blob), each text once, and (product_id, text_id). A text has the number of its first product.

    Products often share a text: what a request asks of texts is worked out for each text once. The products are joined
    by shuffle: as files they are much smaller than in memory, so that Spark would broadcast them."""
    texts = written(products.where("search_blob is not null").groupBy("search_blob").agg(F.min("product_id").alias("text_id")))
    return texts, products.select("product_id", "search_blob").hint("merge").join(texts.hint("merge"), "search_blob").select("product_id", "text_id")


def candidates(requests: DataFrame, products: DataFrame, fuzzy: bool = False) -> DataFrame:
    """(request_id, product_id) where the product can match at all.

    Every rank but the fuzzy one needs each word of the query within the product's text. Texts are listed, by number
    alone, under those pieces of their words that are asked for: the first three letters of a word, or all of a shorter
    one. A request looks under its rarest piece, and the words are then checked. Not capped.
    """
    texts, numbered = texts_of(products)
    wanted = F.transform("tokens", lambda t: F.left(t, F.lit(3)))
    asked = requests.select("request_id", F.explode(F.array_distinct(wanted)).alias("gram"))
    listed = texts.select("text_id", F.explode(grams(F.split("search_blob", " "))).alias("gram")).join(asked.select("gram").distinct(), "gram", "left_semi")
    counts = listed.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = asked.join(counts, "gram").groupBy("request_id").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    pairs = rarest.join(listed, "gram").select("request_id", "text_id").join(requests.select("request_id", "tokens"), "request_id")
    found = pairs.join(texts, "text_id").where(F.forall("tokens", lambda t: F.contains("search_blob", t)))
    found = written(found.select("request_id", "text_id").distinct()).join(numbered.hint("merge"), "text_id").select("request_id", "product_id")
    if fuzzy:
        found = found.unionByName(fuzzy_matches(requests, products).select("request_id", "product_id")).distinct()
    return found


def trigrams(words: Column) -> Column:
    """The trigrams of a text's words in order, each word with two blanks before it and one behind."""
    pieces = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.flatten(F.transform(F.filter(F.split(words, " "), lambda w: w != ""), pieces))


def _once(value: Column, f) -> Column:
    """f of value, which is worked out once for all its uses, inner ones included."""
    return F.transform(F.array(value), f)[0]


def word_similarity(query: Column, blob: Column) -> Column:
    """Greatest likeness of the query's trigrams and those of any run of the blob's: distinct trigrams in both over
    distinct trigrams in either; null texts and texts without words are like nothing (0).

    A best run begins and ends with a trigram of the query. Its distinct trigrams are its length less the places at which
    one comes again, so that only the query's places and those of repeats are gone through.
    """

    def marks(mine: Column, theirs: Column) -> Column:
        """(place, the place where the trigram stood last or 0, whether it is the query's) of the query's and of repeats."""
        back = lambda t, p: F.array_position(F.reverse(F.slice(theirs, F.lit(1), p)), t)
        last = lambda t, p: _once(back(t, p), lambda k: F.when(k > 0, p + 1 - k).otherwise(F.lit(0)))
        every = F.transform(theirs, lambda t, p: F.struct((p + 1).alias("at"), last(t, p).cast("int").alias("last"), F.array_contains(mine, t).alias("own")))
        return F.filter(every, lambda m: m["own"] | (m["last"] > 0))

    def best_from(a: Column, own: Column, again: Column, size: Column) -> Column:
        def grow(run: Column, m: Column) -> Column:
            n = m["at"] - a + 1 - F.size(F.filter(again, lambda r: (r["at"] <= m["at"]) & (r["last"] >= a)))
            common = run["common"] + 1
            return F.when((m["at"] < a) | (m["last"] >= a), run).otherwise(F.struct(common.alias("common"), F.greatest(run["best"], common / (size + n - common)).alias("best")))

        return F.aggregate(own, F.struct(F.lit(0).alias("common"), F.lit(0.0).alias("best")), grow, lambda run: run["best"])

    def best(mine: Column, marked: Column) -> Column:
        among = lambda own, again: F.array_max(F.transform(own, lambda m: best_from(m["at"], own, again, F.size(mine))))
        return _once(F.filter(marked, lambda m: m["own"]), lambda own: _once(F.filter(marked, lambda m: m["last"] > 0), lambda again: among(own, again)))

    found = _once(F.array_distinct(trigrams(query)), lambda mine: _once(_once(trigrams(blob), lambda theirs: marks(mine, theirs)), lambda marked: best(mine, marked)))
    return F.coalesce(found, F.lit(0.0))


def fuzzy_matches(requests: DataFrame, products: DataFrame, least: float = FUZZY) -> DataFrame:
    """(request_id, product_id, similarity) of at least least. Only products that share a trigram of a word's beginning
    with the request are compared: such a share of the trigrams cannot be reached without any in common."""
    pieces = lambda c: F.array_distinct(trigrams(c))
    # Requests often share a query, and products a text: each pair of a query and a text is compared once.
    texts, numbered = texts_of(products)
    mine = requests.select("query").distinct().select("query", F.size(pieces(F.col("query"))).alias("size"), F.explode(pieces(F.col("query"))).alias("gram"))
    theirs = texts.select("text_id", F.explode(pieces(F.col("search_blob"))).alias("gram")).join(mine.select("gram").distinct(), "gram", "left_semi")
    # Of least * size in common, one at least is among the size - ceil(least * size) + 1 that fewest texts have.
    counts = theirs.groupBy("gram").agg(F.count("*").alias("n"))
    rarity = Window.partitionBy("query").orderBy("n", "gram")
    few = mine.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("place", F.row_number().over(rarity)).where(F.col("place") <= F.col("size") - F.ceil(F.lit(least) * F.col("size")) + 1)
    close = few.join(theirs, "gram").select("query", "text_id").distinct()
    shared = F.size(F.array_intersect(pieces(F.col("query")), pieces(F.col("search_blob"))))
    # Both steps are tables: their conditions would else be worked out before the pairs are made distinct, in the few tasks
    # that so few bytes get. Hence as many tasks as a shuffle has.
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = written(close.join(texts, "text_id").repartition(tasks, "query", "search_blob"))
    enough = once.where(shared >= F.lit(least) * F.size(pieces(F.col("query"))))
    alike = written(enough.withColumn("similarity", word_similarity(F.col("query"), F.col("search_blob"))).where(F.col("similarity") >= least).select("query", "text_id", "similarity"))
    discard(once)
    of_requests = alike.join(requests.select("request_id", "query"), "query").select("request_id", "text_id", "similarity")
    return of_requests.hint("merge").join(numbered.hint("merge"), "text_id").select("request_id", "product_id", "similarity")


def shelf(pairs: DataFrame, listings: DataFrame, retailers: DataFrame) -> DataFrame:
    """(request_id, product_id) with shops, min_price, currency, available, n_shops, wanted, over the listings of enabled
    shops in the request's markets (null: all). pairs: request_id, product_id, markets, retailers."""
    sold = listings.join(retailers.where("enabled"), "retailer").select("product_id", "retailer", "market", "price", "currency", "available")
    seen = pairs.join(sold, "product_id").where("markets is null or array_contains(markets, market)")
    return seen.groupBy("request_id", "product_id").agg(
        F.array_sort(F.collect_set("retailer")).alias("shops"), F.min(F.when(F.col("available"), F.col("price"))).alias("min_price"), F.min("currency").alias("currency"),
        F.bool_or("available").alias("available"), F.count_distinct("retailer").alias("n_shops"), F.bool_or(F.coalesce(F.expr("array_contains(retailers, retailer)"), F.lit(False))).alias("wanted"),
    )


def display_names(pairs: DataFrame, products: DataFrame, listings: DataFrame, retailers: DataFrame) -> DataFrame:
    """(request_id, product_id, display_name). pairs: request_id, product_id, markets.

    The canonical name, unless the product was named in a market that the request leaves out; then the name that a shop
    of the request's markets uses: available first, then seen last. Any shop may have named it; only enabled ones speak
    for a market.
    """
    sold = listings.join(retailers, "retailer").join(products.select("product_id", "canonical_name"), "product_id")
    first = F.struct((F.col("retailer_name") != F.col("canonical_name")).alias("other"), F.col("first_seen_at").isNull().alias("unseen"), "first_seen_at", "retailer", "external_id")
    named_in = sold.groupBy("product_id").agg(F.min_by("market", first).alias("named_in"))
    abroad = pairs.where("markets is not null").join(named_in, "product_id").where(~F.array_contains("markets", F.col("named_in")))
    order = Window.partitionBy("request_id", "product_id").orderBy(F.col("available").desc(), F.col("last_seen_at").desc(), "retailer", "external_id")
    local = abroad.select("request_id", "product_id", "markets").join(sold.where("enabled"), "product_id").where("array_contains(markets, market)")
    local = local.withColumn("n", F.row_number().over(order)).where("n = 1").select("request_id", "product_id", F.col("retailer_name").alias("local"))
    out = pairs.select("request_id", "product_id").join(local, ["request_id", "product_id"], "left").join(products.select("product_id", "canonical_name"), "product_id")
    return out.select("request_id", "product_id", F.coalesce("local", "canonical_name").alias("display_name"))


def _scoped(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """asked with the number of its scope in place of markets and retailers, and (scope, markets, retailers), each once."""
    digested = asked.withColumn("digest", F.sha2(F.to_json(F.struct("markets", "retailers")), 256))
    scopes = written(digested.groupBy("digest").agg(F.first(F.struct("markets", "retailers")).alias("s")).select("digest", F.monotonically_increasing_id().alias("scope"), "s.markets", "s.retailers"))
    return written(digested.drop("markets", "retailers").join(scopes.select("digest", "scope"), "digest").drop("digest")), scopes.drop("digest")


def _on_shelf(places: DataFrame, scopes: DataFrame, listings: DataFrame, retailers: DataFrame) -> DataFrame:
    """(scope, product_id, available, several) of those places (scope, product_id) that are sold in the scope's markets, and
    by one of its retailers. Long lists of retailers are joined as rows; shops go by number."""
    shops = written(retailers.select("retailer").distinct().withColumn("shop", F.monotonically_increasing_id()))
    sold = listings.select("product_id", "retailer", "available").join(F.broadcast(retailers.where("enabled").join(shops, "retailer")), "retailer").select("product_id", "shop", "market", "available")
    within = scopes.select("scope", "markets", F.col("retailers").isNull().alias("anywhere"))
    seen = places.hint("merge").join(sold, "product_id").join(within, "scope").where("markets is null or array_contains(markets, market)").drop("markets", "market")
    own = scopes.select("scope", F.explode("retailers").alias("retailer")).distinct().join(shops, "retailer").select("scope", "shop", F.lit(True).alias("own"))
    seen = seen.join(own, ["scope", "shop"], "left")
    facts = seen.groupBy("scope", "product_id").agg(F.bool_or("available").alias("available"), (F.min("shop") != F.max("shop")).alias("several"), F.bool_or(F.col("anywhere") | F.col("own").isNotNull()).alias("wanted"))
    return facts.where("wanted").drop("wanted")


def scored(asked: DataFrame, products: DataFrame, listings: DataFrame, retailers: DataFrame, fuzzy: bool = False) -> DataFrame:
    """All products that match each request, with match_type and score. asked: from tokenised(). What hangs on markets and
    retailers alone is worked out for each such scope and product, not for each request."""
    return _scored(*_scoped(asked), products, listings, retailers, fuzzy)


def _scored(terms: DataFrame, scopes: DataFrame, products: DataFrame, listings: DataFrame, retailers: DataFrame, fuzzy: bool) -> DataFrame:
    pairs = written(candidates(terms, products, fuzzy).join(terms.select("request_id", "scope"), "request_id"))
    places = pairs.select("scope", "product_id").distinct()
    shown = _on_shelf(places, scopes, listings, retailers).withColumn("local", F.lit(None).cast("string"))
    if not (abroad := scopes.where("markets is not null")).isEmpty():
        names = display_names(places.join(abroad.select("scope", "markets"), "scope").withColumnRenamed("scope", "request_id"), products, listings, retailers)
        shown = shown.drop("local").join(names.select(F.col("request_id").alias("scope"), "product_id", F.col("display_name").alias("local")), ["scope", "product_id"], "left")
    of_products = products.select("product_id", "canonical_name", "name_folded", "brand", "brand_folded", "popularity", "quantity", "quantity_unit", "search_blob")
    shown = shown.hint("merge").join(of_products.hint("merge"), "product_id")
    named = {"name": F.when(F.coalesce(F.col("local") != F.col("canonical_name"), F.lit(False)), text.fold(F.col("local"))).otherwise(F.col("name_folded")), "display_name": F.coalesce("local", "canonical_name")}
    known = pairs.hint("merge").join(shown.withColumns(named).hint("merge"), ["scope", "product_id"]).join(terms.drop("scope"), "request_id")
    name, every = F.col("name"), lambda c: F.forall("tokens", lambda t: F.contains(c, t))
    kind = (
        F.when(name == F.col("query"), "name_exact").when(F.startswith(name, F.col("query")), "name_prefix").when(F.col("brand_folded") == F.col("query"), "brand_exact")
        .when(every(name), "name_tokens").when(F.startswith("brand_folded", F.col("query")), "brand_prefix").when(every(F.col("search_blob")), "blob_tokens")
        .when(F.contains("search_blob", F.col("query")), "blob_substring").otherwise("fuzzy")
    )
    known = known.withColumn("match_type", kind)
    rank_points = F.element_at(F.create_map(*[F.lit(x) for kv in RANKS.items() for x in kv]), F.col("match_type"))
    size_named = F.coalesce(F.contains("query", text.number_key(F.col("quantity"))), F.lit(False))
    score = rank_points + F.when(F.col("available"), BONUS_AVAILABLE).otherwise(0) + F.when(F.col("several"), BONUS_SHOPS).otherwise(0) + F.when(size_named, BONUS_QUANTITY).otherwise(0)
    return known.withColumn("score", score).drop("name", "local", "tokens")


def search(requests: DataFrame, products: DataFrame, listings: DataFrame, retailers: DataFrame, limit: int = 100, fuzzy: bool = False) -> DataFrame:
    """The best products for each request (request_id, query, markets, retailers): rank, product_id, name, maker,
    popularity, quantity, quantity_unit, shops, min_price, currency, available, match_type, score. Shops and prices are
    read for the best only."""
    order = Window.partitionBy("request_id").orderBy(F.col("score").desc(), F.col("popularity").desc(), "display_name", "product_id")
    terms, scopes = _scoped(tokenised(requests))
    ranked = _scored(terms, scopes, products, listings, retailers, fuzzy).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= min(max(limit, 1), 200))
    top = written(ranked.select("request_id", "scope", "rank", "product_id", F.col("display_name").alias("name"), F.col("brand").alias("maker"), "popularity", "quantity", "quantity_unit", "match_type", "score"))
    # A row for each scope and product, however many requests found it; markets join as the only part of the scope.
    best = top.select("scope", "product_id").distinct().join(scopes.select("scope", "markets"), "scope").select(F.col("scope").alias("request_id"), "product_id", "markets", F.lit(None).cast("array<string>").alias("retailers"))
    sold = shelf(best, listings, retailers).withColumnRenamed("request_id", "scope")
    return top.join(sold, ["scope", "product_id"]).select("request_id", "rank", "product_id", "name", "maker", "popularity", "quantity", "quantity_unit", "shops", "min_price", "currency", "available", "match_type", "score")


def lookup_barcodes(requests: DataFrame, products: DataFrame, identifiers: DataFrame, listings: DataFrame, retailers: DataFrame) -> DataFrame:
    """At most one product for each request (request_id, codes, markets): name, maker, popularity."""
    codes = requests.select("request_id", "markets", F.explode("codes").alias("identifier_value")).distinct()
    hits = codes.join(identifiers.where("identifier_type = 'gtin'").select("identifier_value", "product_id"), "identifier_value").select("request_id", "markets", "product_id").distinct()
    sold = listings.join(retailers.where("enabled"), "retailer").select("product_id", "market").distinct()
    in_market = hits.where("markets is not null").join(sold, "product_id").where("array_contains(markets, market)").select("request_id", "markets", "product_id").distinct()
    hits = hits.where("markets is null").unionByName(in_market).join(products.select("product_id", "canonical_name", "brand", "popularity"), "product_id")
    order = Window.partitionBy("request_id").orderBy(F.col("popularity").desc(), "canonical_name", "product_id")
    best = hits.withColumn("n", F.row_number().over(order)).where("n = 1")
    return best.join(display_names(best, products, listings, retailers), ["request_id", "product_id"]).select("request_id", "product_id", F.col("display_name").alias("name"), F.col("brand").alias("maker"), "popularity")


def shops_for(requests: DataFrame, products: DataFrame, listings: DataFrame, retailers: DataFrame, most: int = 200) -> DataFrame:
    """For each name of each request (request_id, names, markets; the first 200 names): the best product of that name and
    the shops that sell it. With markets, products that they don't sell go before the choice."""
    asked = requests.select("request_id", "markets", F.explode(F.slice("names", 1, most)).alias("folded")).withColumn("folded", text.fold(F.col("folded"))).where("folded <> ''").distinct()
    own = products.select(F.col("name_folded").alias("folded"), "product_id")
    shown = listings.select("retailer_name", "product_id").distinct().select(text.fold(F.col("retailer_name")).alias("folded"), "product_id")
    hits = asked.join(own.unionByName(shown).distinct(), "folded")
    sold = listings.join(retailers.where("enabled"), "retailer").select("product_id", "retailer", "market")
    shops = hits.join(sold, "product_id").where("markets is null or array_contains(markets, market)").groupBy("request_id", "folded", "product_id").agg(F.array_sort(F.collect_set("retailer")).alias("shops"))
    kept = hits.join(shops, ["request_id", "folded", "product_id"], "left").where("markets is null or shops is not null").join(products.select("product_id", "canonical_name", "brand", "popularity"), "product_id")
    order = Window.partitionBy("request_id", "folded").orderBy(F.col("popularity").desc(), "canonical_name", "product_id")
    best = kept.withColumn("n", F.row_number().over(order)).where("n = 1")
    names = display_names(best.select("request_id", "product_id", "markets").distinct(), products, listings, retailers)
    return best.join(names, ["request_id", "product_id"]).select("request_id", "folded", "product_id", F.col("display_name").alias("name"), F.col("brand").alias("maker"), "shops")
