"""Imports, runs, search and edits against small hand-made catalogs and a sequential model."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from marketloom import schema
from marketloom.operators import admin, crawl, logs, match, popularity, runs, search, validate
from marketloom.session import written

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
COLUMNS = ["ordinal", "external_id", "name", "brand", "gtin", "price", "currency", "quantity", "unit", "category", "product_url", "available"]


def rows_of(spark, rows):
    import decimal

    full = [
        (i, r.get("id"), r.get("name"), r.get("brand"), r.get("gtin"), None if r.get("price") is None else decimal.Decimal(str(r["price"])), r.get("currency", "RON"), None if r.get("quantity") is None else decimal.Decimal(r["quantity"]), r.get("unit"), r.get("category"), r.get("url", "https://x/1"), r.get("available", True))
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, "ordinal long, " + schema.IMPORT_ROW)


def empty(spark):
    return spark.createDataFrame([], schema.PRODUCT + ", merge_key string"), spark.createDataFrame([], schema.IDENTIFIER), spark.createDataFrame([], schema.LISTING)


def sequential(batches):
    """The import as a plain loop: (product of each row or None for an error) by batch, and the counters."""
    products, by_key, gtins, listings, out = {}, {}, {}, {}, []

    def key(b, n, q, u):
        return f"{re.sub('[^a-z0-9]+', ' ', (b or '').lower()).strip()}|{n.lower()}|{f'{u}:{q}' if u else '-'}"

    for shop, rows in batches:
        got = []
        for r in rows:
            by_g, by_l = gtins.get(r.get("gtin")), listings.get((shop, r["id"]))
            g = r.get("gtin")
            if by_g and by_l and by_g != by_l:
                pid, g = by_l, None
            else:
                pid = by_g or by_l
            k = key(r.get("brand"), r["name"], r.get("quantity"), r.get("unit"))
            pid = pid or by_key.get(k)
            if not pid:
                pid = f"{shop}:{r['id']}"
                if pid in products:
                    got.append(None)
                    continue
                products[pid] = [r.get("brand"), r["name"], r.get("quantity"), r.get("unit"), k]
                by_key[k] = pid
            else:
                p = products[pid]
                b = p[0] or r.get("brand")
                q, u = (r.get("quantity"), r.get("unit")) if p[2] is None and r.get("unit") else (p[2], p[3])
                new = key(b, p[1], q, u)
                if new != p[4] and new in by_key:
                    got.append(None)
                    continue
                by_key.pop(p[4])
                by_key[new] = pid
                products[pid] = [b, p[1], q, u, new]
            listings[(shop, r["id"])] = pid
            if g and g not in gtins:
                gtins[g] = pid
            got.append(pid)
        out.append(got)
    return out, {p: v[4] for p, v in products.items()}


def run_batches(spark, batches):
    state, out = empty(spark), []
    for n, (shop, rows) in enumerate(batches):
        done = match.import_rows(rows_of(spark, rows), shop, T0 + dt.timedelta(days=n), *state)
        out.append([r["product_id"] for r in done.decision.orderBy("ordinal").collect()])
        state = written(done.product), written(done.identifier), written(done.listing)
    return out, {r["product_id"]: r["merge_key"] for r in state[0].collect()}, state, done


@pytest.mark.parametrize("seed", range(3))
def test_import_is_the_sequential_loop(spark, seed):
    rng = random.Random(seed)

    def row():
        size = rng.random() < 0.5
        return {"id": str(rng.randrange(6)), "name": rng.choice(["milk", "tea", "rye"]), "brand": rng.choice([None, "a", "b"]), "gtin": rng.choice([None, None, "12345678", "87654321", "11111111"]), "price": 1, "quantity": "2" if size else None, "unit": "g" if size else None}

    batches = [("s1", [row() for _ in range(8)]), ("s2", [row() for _ in range(8)]), ("s1", [row() for _ in range(6)])]
    expected, keys = sequential(batches)
    got, got_keys, _, _ = run_batches(spark, batches)
    assert got == expected
    assert got_keys == keys


def test_a_hot_component_is_the_sequential_loop_in_few_rounds(spark, monkeypatch):
    """Half of the rows share a name, a barcode, a listing or all; brands that fold to nothing, sizes and brands that come
    later, keys that are taken."""
    rng, rounds, plain = random.Random(11), [], match._round
    monkeypatch.setattr(match, "_round", lambda *a: rounds.append(1) or plain(*a))

    def row(k):
        size = rng.choice([None, "2", "3"])
        shown = {"id": str(rng.randrange(30) if k % 2 else 99), "name": rng.choice(["hot", "hot", "hot", "tea", "rye"]), "brand": rng.choice([None, None, "a", "b", "!!"])}
        return shown | {"gtin": rng.choice([None, None, "11111111", "11111111", "22222222", f"{33333333 + k}"]), "price": 1, "quantity": size, "unit": "g" if size else None}

    batches = [("s1", [row(k) for k in range(70)])]
    expected, keys = sequential(batches)
    got, got_keys, _, done = run_batches(spark, batches)
    assert got == expected and got_keys == keys
    assert len(rounds) <= 20
    plan = done.decision._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_import_twice_changes_nothing(spark):
    rows = [{"id": "1", "name": "Milk 1 l", "brand": "Zuzu", "gtin": "12345678", "price": 5}, {"id": "2", "name": "Tea", "price": 2}, {"id": "3", "name": None}]
    _, _, state, first = run_batches(spark, [("s", rows)])
    c = match.import_counters(first).first().asDict()
    assert c == {"inserted": 2, "updated": 0, "unchanged": 0, "products_created": 2, "identifiers_added": 1, "conflicts": 0, "errors": 1}
    again = match.import_rows(rows_of(spark, rows), "s", T1, *state)
    assert match.import_counters(again).first().asDict() == {"inserted": 0, "updated": 0, "unchanged": 2, "products_created": 0, "identifiers_added": 0, "conflicts": 0, "errors": 1}
    one = again.listing.where("external_id = '1'").first()
    assert (one["first_seen_at"], one["last_seen_at"], one["last_price_at"], one["previous_price"]) == (T0, T1, T0, None)
    dearer = match.import_rows(rows_of(spark, [{**rows[0], "price": 6}]), "s", T1, *state).listing.where("external_id = '1'").first()
    assert (float(dearer["previous_price"]), float(dearer["price"]), dearer["last_price_at"]) == (5.0, 6.0, T1)
    assert [r["error"] for r in match.first_errors(first).collect()] == ["incomplete_row"]


def test_barcode_conflict_keeps_the_listings_product(spark):
    first = [{"id": "1", "name": "A", "gtin": "11111111", "price": 1}, {"id": "2", "name": "B", "gtin": "22222222", "price": 1}]
    _, _, state, _ = run_batches(spark, [("s", first)])
    done = match.import_rows(rows_of(spark, [{"id": "1", "name": "A", "gtin": "22222222", "price": 1}]), "s", T1, *state)
    d = done.decision.first()
    assert (d["product_id"], d["conflict"], d["add_gtin"]) == ("s:1", True, None)


def test_validation_and_split(spark):
    rows = spark.createDataFrame([("1", "Whisky 0.7 l + 2 pahare", 5.0), ("", "x", 1.0), ("2", "Tea", 1.005), ("3", "Tea", float("nan")), ("4", "y" * 201, 1.0)], "external_id string, name string, price double")
    rows = rows.withColumns({c: F.lit(None).cast(k) for c, k in (("brand", "string"), ("gtin", "string"), ("currency", "string"), ("quantity", "double"), ("unit", "string"), ("category", "string"), ("available", "boolean"))}).withColumn("product_url", F.lit("//x"))
    valid, rejected, excluded = validate.split(rows)
    assert [r["external_id"] for r in valid.collect()] == ["2"] and valid.first()["currency"] == "RON"
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["bad-price", "name-too-long", "no-external-id"]
    assert excluded.count() == 1
    assert validate.dangling(valid.select("external_id"), rejected.select("external_id"), "external_id").count() == 1


def runs_of(spark, rows):
    return spark.createDataFrame([(i, "s", st, T0 + dt.timedelta(days=d), None, 0, n, 0, None) for i, st, d, n in rows], schema.RUN)


def listing_of(spark, rows):
    return spark.createDataFrame([(p, shop, e, name, None, None, None, "EUR", av, "https://x", None, None, first, last) for p, shop, e, name, av, first, last in rows], schema.LISTING)


@pytest.mark.parametrize(("found", "covered", "status"), [(0, False, "partial"), (49, False, "partial"), (50, False, "completed"), (49, True, "completed"), (200, False, "completed")])
def test_verdict_and_sweep(spark, found, covered, status):
    all_runs = runs_of(spark, [("old", "completed", 0, 100), ("bad", "failed", 1, 900), ("now", "running", 2, found)])
    closing = all_runs.where("run_id = 'now'").select("run_id", "retailer", "started_at", "products_valid").withColumn("covered", F.lit(covered))
    t2 = T0 + dt.timedelta(days=2)
    listing = listing_of(spark, [("p", "s", "1", "a", True, T0, T0), ("p", "s", "2", "b", True, T0, t2), ("p", "z", "3", "c", True, T0, T0)])
    after, swept = runs.close(closing, all_runs, listing, t2)
    assert after.where("run_id = 'now'").first()["status"] == status
    gone = [r["external_id"] for r in swept.where("not available").collect()]
    assert gone == (["1"] if status == "completed" else [])
    again, _ = runs.close(closing, after, listing, t2)
    assert again.where("run_id = 'now'").first()["status"] == status


def test_reap_stop_and_counters(spark):
    r = runs_of(spark, [("a", "running", 0, 0), ("b", "running", 1, 0)])
    reaped = {x["run_id"]: x["status"] for x in runs.reap(r, T0 + dt.timedelta(hours=13)).collect()}
    assert reaped == {"a": "failed", "b": "running"}
    assert runs.open_run(r, "c", "s", T1).where("status = 'running'").count() == 2
    stopped = runs.stop(r, spark.createDataFrame([("a", "partial", "limit")], "run_id string, new_status string, reason string"), T1)
    assert stopped.where("run_id = 'a'").first()["status"] == "partial"
    added = runs.add_counters(stopped, spark.createDataFrame([("a", 5), ("b", 3), ("b", -9)], "run_id string, products_found long"), ["products_found"])
    assert {x["run_id"]: x["products_found"] for x in added.collect()} == {"a": 0, "b": 3}
    said = spark.createDataFrame([("b", 1, T0, {"x": "1", "y": "1"}), ("b", 1, T1, {"x": "2"}), ("a", 1, T1, {"x": "3"}), ("b", 1, T1, None)], "run_id string, products_found long, reported_at timestamp, stats map<string,string>")
    merged = runs.add_counters(stopped.withColumn("stats", F.create_map(F.lit("y"), F.lit("0"), F.lit("z"), F.lit("0"))), said, ["products_found"])
    assert {x["run_id"]: (x["products_found"], x["stats"]) for x in merged.collect()} == {"a": (0, {"y": "0", "z": "0"}), "b": (3, {"x": "2", "y": "1", "z": "0"})}
    live = stopped.withColumns({"pages_read": F.lit(1).cast("long"), "last_alive_at": F.lit(None).cast("timestamp"), "progress_done": F.lit(None).cast("long"), "progress_total": F.lit(9).cast("long"), "progress_unit": F.lit("page")})
    told = spark.createDataFrame([("b", T0, 5, 3, 10, "shelf"), ("b", T1, -2, 4, None, " "), ("a", T1, 7, 7, 7, "x")], "run_id string, reported_at timestamp, pages long, done long, total long, unit string")
    got = {x["run_id"]: (x["pages_read"], x["last_alive_at"], x["progress_done"], x["progress_total"], x["progress_unit"]) for x in runs.alive(live, told).collect()}
    assert got == {"a": (1, None, None, 9, "page"), "b": (6, T1, 4, 10, "shelf")}


def test_run_listings_and_purge(spark):
    t2 = T0 + dt.timedelta(days=2)
    all_runs = runs_of(spark, [("r0", "completed", 0, 2), ("r1", "completed", 1, 2), ("r2", "completed", 2, 1)])
    listing = listing_of(spark, [("p", "s", "1", "a", False, T0, T1), ("q", "s", "2", "b", True, t2, t2), ("o", "s", "3", "c", False, T0, T0)])
    kinds = {k: sorted((r["run_id"], r["external_id"]) for r in runs.run_listings(all_runs, listing, k).collect()) for k in ("new", "gone")}
    assert kinds == {"new": [("r0", "1"), ("r0", "3"), ("r2", "2")], "gone": [("r1", "3"), ("r2", "1")]}
    assert runs.page(runs.run_listings(all_runs, listing, "new"), 1).first()["total"] == 3
    with pytest.raises(ValueError, match="unknown kind"):
        runs.run_listings(all_runs, listing, "odd")
    goods = spark.createDataFrame([("p",), ("q",), ("o",)], "product_id string")
    shops = spark.createDataFrame([("s",)], "retailer string")
    evidence = spark.createDataFrame([("s", "1"), ("s", "9")], "retailer string, external_id string")
    left, _, kept, counts = runs.purge(evidence, goods, goods, listing, shops)
    assert sorted(r[0] for r in left.collect()) == ["o", "q"] and kept.count() == 2
    assert counts.first().asDict() == {"listings_deleted": 1, "products_deleted": 1}
    with pytest.raises(ValueError, match="unknown retailer"):
        runs.purge(evidence.withColumn("retailer", F.lit("zz")), goods, goods, listing, shops)


@pytest.fixture(scope="module")
def shop(spark):
    shops = spark.createDataFrame([("ro", "RO", True), ("de", "DE", True), ("off", "RO", False)], "retailer string, market string, enabled boolean")
    goods = spark.createDataFrame(
        [("p1", "Lapte", "Zuzu", 1.0, "l", 3, "lapte zuzu milch"), ("p2", "Lapte bătut", "Napolact", None, None, 9, "lapte batut napolact"), ("p3", "Kefir lapte", "Lapte", None, None, 1, "kefir lapte lapte"), ("p4", "Alone", None, None, None, 50, "alone")],
        "product_id string, canonical_name string, brand string, quantity double, quantity_unit string, popularity long, search_blob string",
    )
    from marketloom.functions import text

    goods = goods.withColumns({"name_folded": text.fold(F.col("canonical_name")), "brand_folded": text.fold(F.col("brand"))})
    listing = listing_of(spark, [("p1", "ro", "1", "Lapte", True, T1, T1), ("p1", "de", "1", "Milch", True, T0, T1), ("p2", "off", "2", "Lapte bătut", True, T0, T0), ("p2", "ro", "2", "Lapte bătut", False, T0, T0), ("p3", "de", "3", "Kefir", True, T0, T0)])
    return goods, listing, shops


def ask(spark, query, markets=None, retailers=None):
    return spark.createDataFrame([("r", query, markets, retailers)], "request_id string, query string, markets array<string>, retailers array<string>")


def test_search_ranks_and_markets(spark, shop):
    goods, listing, shops = shop
    got = [(r["product_id"], r["match_type"], r["score"]) for r in search.search(ask(spark, " LAPTE "), goods, listing, shops).orderBy("rank").collect()]
    assert got == [("p1", "name_exact", 108), ("p2", "name_prefix", 80), ("p3", "brand_exact", 75)]
    german = search.search(ask(spark, "lapte", ["DE"]), goods, listing, shops).orderBy("rank").collect()
    assert [(r["product_id"], r["name"], r["match_type"]) for r in german] == [("p3", "Kefir lapte", "brand_exact"), ("p1", "Milch", "blob_tokens")]
    only = search.search(ask(spark, "lapte", None, ["de"]), goods, listing, shops).collect()
    assert {r["product_id"] for r in only} == {"p1", "p3"} and next(r for r in only if r["product_id"] == "p1")["shops"] == ["de", "ro"]
    assert search.search(ask(spark, "x"), goods, listing, shops).count() == 0
    assert search.search(ask(spark, "alone"), goods, listing, shops).count() == 0  # on no shelf
    assert [r["match_type"] for r in search.search(ask(spark, "laptee zuzu"), goods, listing, shops, fuzzy=True).collect()][:1] == ["fuzzy"]


def test_display_name_barcode_and_badges(spark, shop):
    goods, listing, shops = shop
    pairs = goods.select(F.lit("r").alias("request_id"), "product_id", F.array(F.lit("DE")).alias("markets"))
    names = {r["product_id"]: r["display_name"] for r in search.display_names(pairs, goods, listing, shops).collect()}
    assert names == {"p1": "Milch", "p2": "Lapte bătut", "p3": "Kefir lapte", "p4": "Alone"}
    codes = spark.createDataFrame([("p1", "gtin", "11"), ("p4", "gtin", "44")], "product_id string, identifier_type string, identifier_value string")
    asked = spark.createDataFrame([("a", ["11"], ["DE"]), ("b", ["44"], None), ("c", ["44"], ["DE"]), ("d", ["44", "11"], None)], "request_id string, codes array<string>, markets array<string>")
    got = {r["request_id"]: r["name"] for r in search.lookup_barcodes(asked, goods, codes, listing, shops).collect()}
    assert got == {"a": "Milch", "b": "Alone", "d": "Alone"}
    asked = spark.createDataFrame([("a", ["MILCH", "Lapte batut", ""], None), ("b", ["lapte batut"], ["DE"])], "request_id string, names array<string>, markets array<string>")
    got = {(r["request_id"], r["folded"]): (r["product_id"], r["shops"]) for r in search.shops_for(asked, goods, listing, shops).collect()}
    assert got == {("a", "milch"): ("p1", ["de", "ro"]), ("a", "lapte batut"): ("p2", ["ro"])}


def test_admin_edits(spark):
    goods = spark.createDataFrame([("p1", "Tea", "A", None, None, "drinks", "a|tea|-"), ("p2", "Rye", None, None, None, None, "|rye|-")], "product_id string, canonical_name string, brand string, quantity decimal(18,3), quantity_unit string, category string, merge_key string")
    codes = spark.createDataFrame([("p1", "gtin", "12345678", "admin"), ("p2", "gtin", "87654321", "shop")], schema.IDENTIFIER)
    new = spark.createDataFrame([(1, "Oat", None, None, None, None), (2, "TEA", "a", None, None, None), (3, "", None, None, None, None), (4, "Corn", None, None, None, "12345678"), (5, "Bran", None, None, None, "12"), (6, "Fig", None, None, None, "11112222"), (7, "Nut", None, None, None, "11112222"), (8, "Pea", None, None, None, "33334444")], "edit_id int, name string, brand string, quantity decimal(18,3), unit string, barcode string")
    accepted, coded, rejected = admin.create(new, goods, codes)
    assert sorted(r["edit_id"] for r in accepted.collect()) == [1, 8]
    assert sorted(r["identifier_value"] for r in coded.collect()) == ["12345678", "33334444", "87654321"]
    assert {r["edit_id"]: r["error"] for r in rejected.collect()} == {2: "duplicate_product", 3: "bad_name", 4: "duplicate_barcode", 5: "bad_barcode", 6: "duplicate_barcode", 7: "duplicate_barcode"}
    edits = spark.createDataFrame([(0, "p1", "Coffee", None, None, None), (1, "p1", None, "", "pantry", "55556666"), (2, "p9", "x", None, None, None), (3, "p2", None, None, None, "")], "edit_id int, product_id string, name string, brand string, category string, barcode string")
    after, coded, bad = admin.update(edits, goods, codes)
    assert after.count() == 2 and sorted((r["product_id"], r["identifier_value"]) for r in coded.collect()) == [("p1", "55556666"), ("p2", "87654321")]
    p1 = after.where("product_id = 'p1'").first()
    assert (p1["canonical_name"], p1["brand"], p1["category"], p1["merge_key"]) == ("Tea", None, "pantry", "|tea|-")
    assert [r["error"] for r in bad.collect()] == ["unknown_product"]
    assert admin.delete(spark.createDataFrame([("p1",)], "product_id string"), goods, codes)[1].first()["product_id"] == "p2"


def test_popularity_and_logs(spark, shop):
    goods, listing, _ = shop
    goods = goods.withColumns({"add_count": F.lit(0), "merge_key": F.concat_ws("|", "brand_folded", "name_folded", F.lit("-"))})
    bumps = spark.createDataFrame([(1, 7, T0, "LAPTE", "zuzu"), (2, 7, T0, "Lapte", "zuzu"), (3, 7, T0, "Lapte", "zuzu"), (4, 8, T0, "Milch", None), (5, None, T0, "Lapte", "zuzu"), (6, 9, T0, "nothing", None)], "bump_id int, user_id int, ts timestamp, name string, maker string")
    got = {r["product_id"]: r["add_count"] for r in popularity.bump(bumps, goods, listing, 2).collect()}
    assert got == {"p1": 3, "p2": 0, "p3": 0, "p4": 0}
    lines = spark.createDataFrame([("r", T0 + dt.timedelta(seconds=i), "info" if i < 5 else "error", "s", str(i)) for i in range(8)], "run_id string, t timestamp, level string, scope string, message string")
    kept = logs.capped(lines, {"info": 2}).collect()
    assert sorted(r["message"] for r in kept) == sorted(["0", "1", "5", "6", "7", "3 info lines were not kept: a run keeps at most 2"])


def test_crawl_rules(spark):
    pages = spark.createDataFrame([("d", 1, ["a"]), ("d", 2, ["b"]), ("d", 3, ["b"]), ("d", 4, ["c"]), ("e", 1, [])], "department string, page int, ids array<string>")
    assert sorted((r["department"], r["page"]) for r in crawl.until_repeat(pages).collect()) == [("d", 1), ("d", 2)]
    paths = spark.createDataFrame([(["/1/", "/1/2/"],), (["/1/9/"],), (["/3/"],)], "p array<string>")
    assert [r[0] for r in paths.select(crawl.in_allowlist(F.col("p"), ["/1/"], ["/1/9/"])).collect()] == [True, False, False]
    urls = spark.createDataFrame([("u1", "/food/"), ("u2", "/food/pets/toys/"), ("u3", "/food/milk/")], "url string, path string")
    assert [r["url"] for r in crawl.departments(urls, ["/food/"], ["/food/pets/"]).collect()] == ["u3"]
