"""Text, size and code rules against fixed values."""

import random

from pyspark.sql import functions as F

from marketloom.functions import products, text
from marketloom.operators.search import word_similarity

FOLDS = [
    ("Apă Plată", "apa plata", "apa plata"), ("Șuncă Țărănească", "sunca taraneasca", "sunca taraneasca"), ("ÎNGHEȚATĂ", "inghetata", "inghetata"), ("Ţigări", "tigari", "tigari"), ("Müsli Bär", "musli bar", "musli bar"),
    ("Nestlé® Cocoa", "nestle(r) cocoa", "nestle r cocoa"), ("Straße", "strasse", "strasse"), ("œuf", "oeuf", "oeuf"), ("Đakovo", "dakovo", "dakovo"), ("Æther", "aether", "aether"), ("½ litru", "1/2 litru", "1 2 litru"),
    ("Coca-Cola   Zero", "coca-cola zero", "coca cola zero"), ("  spaced  out  ", "spaced out", "spaced out"), ("Lapte 3,5%", "lapte 3,5%", "lapte 3 5%"), ("A/B test", "a/b test", "a b test"), ("Ciocolată 2 × 100 g", "ciocolata 2 * 100 g", "ciocolata 2 100 g"),
    ("Þór «x» ±1 ⅓ ŋ", "thor <<x>> +/-1 1/3 n", "thor x 1 1 3 n"),
    ("L'Or Espresso", "l'or espresso", "l or espresso"), (None, "", ""), ("", "", ""),
]


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select("i", f(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_folds(spark):
    given_, fold, key = zip(*FOLDS)
    assert column(spark, given_, text.fold) == list(fold)
    assert column(spark, given_, text.key_fold) == list(key)


def test_sizes(spark):
    cases = {
        "Lapte UHT Zuzu 3.5% 1L": (1.0, "l"), "Bere 6 x 0,5 L": (3.0, "l"), "Ciocolată 2 × 100 g": (100.0, "g"), "Apa 50 cl": (500.0, "ml"), "Vitamina 500 mg": (0.5, "g"), "Oua 10 buc": (10.0, "buc"), "Set 3 set": (3.0, "buc"),
        "Lapte 3.5%": None, "1 large": None, "": None, None: None, "0 g": None, "9999999 kg": None, "Faina 1kg": (1.0, "kg"), "2 kg + 100 g": (100.0, "g"),
    }
    got = column(spark, list(cases), text.parse_quantity)
    assert [g and (float(g["quantity"]), g["unit"]) for g in got] == list(cases.values())


def test_strip_quantity(spark):
    cases = {"Lapte Zuzu, 1 l": "Lapte Zuzu", "Mere +/- 1 kg": "Mere", "Bere 6 x 0,5 L": "Bere", "Cola - 2 l": "Cola", "Oua 10 bucăți": "Oua", "Pizza 4 grame": "Pizza", "10 large eggs": "10 large eggs", None: ""}
    assert column(spark, list(cases), text.strip_quantity) == list(cases.values())


def test_number_and_quantity_keys(spark):
    rows = spark.createDataFrame([(1500.0, "g"), (1.5, "kg"), (0.33, "l"), (6.0, "buc"), (1.0, "box"), (None, "g")], "q double, u string")
    assert [r[0] for r in rows.select(text.canonical_quantity(F.col("q"), F.col("u"))).collect()] == ["g:1500", "g:1500", "ml:330", "buc:6", "-", "-"]


def test_gtin(spark):
    cases = {"4006381333931": True, "4006381333932": False, "96385074": True, "036000291452": True, "1234567": False, "abc": False, None: False, " 4006381333931 ": True}
    assert [bool(x) for x in column(spark, list(cases), text.valid_gtin)] == list(cases.values())


def test_brand_url_price_stock(spark):
    assert column(spark, ["Non-Brand", "W5", " ", None, "x" * 81, "Fără marcă"], text.usable_brand) == [None, "W5", None, None, None, None]
    assert column(spark, ["//a/b", "https://a", "http://a", None, "https://" + "x" * 1000], text.https_url) == ["https://a/b", "https://a", None, None, None]
    assert column(spark, ["12,99 lei", "1.299,50", "1,299.50", "7", "", None], text.parse_price) == [12.99, 1299.5, 1299.5, 7.0, None, None]
    assert column(spark, ["https://schema.org/InStock", "InStoreOnly", "OutOfStock", None], text.is_available) == [True, True, False, False]
    assert column(spark, ["HANUL BOIERESC", "Mixed Case"], text.unshout) == ["Hanul boieresc", "Mixed Case"]


def test_bundles(spark):
    cases = {
        "Whisky 0.7 l + 2 pahare": True, "Bere 5 x 0.5 l + geanta": True, "Set pentru cadou Dove": True, "Gift Box": True, "Gin Bombay + pahar, 47.5% alc.": True,
        "Cola 2 x 2 l + Coca-Cola Zero": False, "Mere +/- 1 kg": False, "Set 3 boluri + capac": False, "Men+Care": False, None: False,
    }
    assert column(spark, list(cases), text.is_bundle) == list(cases.values())


def test_jobs(spark):
    rows = spark.createDataFrame([("s", "Fructe & legume", "MERE 2 KG", "IDARED", None, "//x/p/40063813339311", "3,5", "InStock")], "retailer string, shelf string, name string, brand string, gtin string, product_url string, price string, availability string")
    out = products.with_keys(products.with_size(products.with_clean_fields(rows, r"/p/(\d+)$", "2")))
    rules = spark.createDataFrame([("s", 1, "lapte", "dairy"), ("s", 2, "fructe|legume", "produce")], "retailer string, ord int, pattern string, category string")
    r = products.with_flags(products.with_category(out, rules)).first()
    assert (r["name"], r["brand"], r["external_id"], r["price"], r["category"], r["available"]) == ("Mere 2 kg", "Idared", "40063813339311", 3.5, "produce", True)
    assert r["merge_key"] == "idared|mere|g:2000"
    mixed = products.with_clean_fields(rows.withColumns({"name": F.lit("MERE 2 kg"), "price": F.lit(12345678.5)})).first()
    assert (mixed["name"], mixed["price"]) == ("MERE 2 kg", 12345678.5)  # not all capitals; a number is no text


def best_run(query, blob):
    grams = lambda s: [g for w in s.split() for g in (lambda p: [p[i : i + 3] for i in range(len(p) - 2)])(f"  {w} ")]
    mine, theirs = set(grams(query)), grams(blob)
    return max((len(mine & (r := set(theirs[i:j]))) / len(mine | r) for i in range(len(theirs)) for j in range(i + 1, len(theirs) + 1)), default=0.0)


def test_word_similarity_is_the_best_run(spark):
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("abc ") for _ in range(rng.randint(1, n)))
    pairs = [("word", "two words"), ("lapte", "lapte zuzu"), ("abc", "xyz"), ("abc", ""), ("aaaa", "aaaa aaaa a"), *((some(8), some(16)) for _ in range(400))]
    pairs = [(q, b) for q, b in pairs if q.strip()]
    rows = spark.createDataFrame([(i, q, b) for i, (q, b) in enumerate([*pairs, (None, "abc"), ("abc", None)])], "i int, q string, b string")
    got = [r[0] for r in rows.orderBy("i").select(word_similarity(F.col("q"), F.col("b"))).collect()]
    assert got == [best_run(q, b) for q, b in pairs] + [0.0, 0.0]
    assert got[:2] == [0.8, 1.0]
