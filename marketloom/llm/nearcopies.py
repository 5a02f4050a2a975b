"""Near copies of texts by exact Jaccard similarity of their five-word shingles.

Texts with the same set of shingles are one class. Bands of min-hashes bring classes together in buckets. Classes that
share a bucket have sketches, a bit of each of SKETCH min-hashes; a pair whose sketches differ in more bits than near
copies do is no pair, which the join on the bucket itself finds out, so that a large group of texts that are alike, but
not enough, costs bit counts and no texts. Every other pair is compared exactly, unless the two are joined already by
other pairs. A bucket's classes are first compared with one of them, then with some LEADS of them, and then with all that
they are not joined to. Links are joined into components after each turn, so that a large group of copies costs some
comparisons for each member and not one for each pair: what the last turn compares are pairs of different components that
come close to the line, which nothing but their texts tells from links.
Texts whose numbers of shingles differ too much to be near copies are no pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, discard, give_back, written

#: Words of a shingle; similarity from which texts are near copies. At 0.8 a pair misses all buckets once in 2800 times.
SHINGLE, SIMILAR = 5, 0.8
BANDS, DEPTH, SEED = 20, 5, 42
#: Classes of a large bucket that all of its others are held against before all are held against all: on average.
LEADS = 16
#: Bits of a sketch, and the words of it that are looked at first.
SKETCH, FIRST_WORDS = 4096, 16


def differ(bits: int) -> int:
    """How many of so many bits may differ: at a similarity of 0.8 a tenth does on average (410 of 4,096, with a deviation of
    19), so that four deviations more leave a pair out once in 30,000 times; they let hardly a pair below 0.72 through."""
    odd = (1 - SIMILAR) / 2
    return round(bits * odd + 4 * (bits * odd * (1 - odd)) ** 0.5)


_RNG = np.random.default_rng(23)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * DEPTH, np.uint64) << np.uint64(1) | np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * DEPTH, np.uint64)
_SKETCH_TIMES = _RNG.integers(0, 1 << 31, SKETCH, np.uint32) << np.uint32(1) | np.uint32(1)
_SKETCH_PLUS = _RNG.integers(0, 1 << 32, SKETCH, np.uint32)


def shingles(text: bytes) -> set[bytes]:
    """All runs of SHINGLE words; fewer words make one shingle, none make no shingle."""
    words = text.lower().split()
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))


def similarity(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def _minima(h: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    low, step = np.full(len(times), ~times.dtype.type(0)), max(1, (1 << 15) // len(times))
    for i in range(0, len(h), step):  # blocks that stay in a core's cache
        x = h[i : i + step, None] * times
        x += plus
        np.minimum(low, x.min(axis=0), out=low)
    return low


def _hashes(grams: set[bytes]) -> np.ndarray:
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams)))


def sketch(text: bytes) -> np.ndarray:
    """A bit of each of SKETCH min-hashes, as 64-bit integers."""
    low = _minima((_hashes(shingles(text)) >> np.uint64(32)).astype(np.uint32), _SKETCH_TIMES, _SKETCH_PLUS)
    return np.packbits((low * np.uint32(0x9E3779B1)) >> np.uint32(31) == 1).view(np.int64)


def signature(text: bytes, fingerprint) -> tuple[int, list[int], int, int]:
    """Name of the set of shingles, a bucket for each band, the fingerprint of the shingles' hashes, and their number."""
    digest = xxhash.xxh64_intdigest
    h = _hashes(shingles(text))
    low = _minima(h, _TIMES, _PLUS)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    buckets = [signed(digest(row.tobytes(), k)) for k, row in enumerate(low.reshape(BANDS, DEPTH))]
    return signed(digest(h.tobytes(), SEED)), buckets, signed(fingerprint(h)), len(h)


def signed(docs: DataFrame, fingerprint) -> DataFrame:
    """docs with __row (its own number), __cls, __buckets, __fp and __size; fingerprint: a function of an array of hashes."""
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    schema = rows.withColumns({"__cls": F.lit(0).cast("long"), "__buckets": F.array(F.lit(0).cast("long")), "__fp": F.lit(0).cast("long"), "__size": F.lit(0).cast("long")}).schema

    def run(batches):
        for b in batches:
            found = list(zip(*[signature(x, fingerprint) for x in blobs(b.column("text"))])) or [(), (), (), ()]
            added = [pa.array(c, t) for c, t in zip(found, (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, "__cls", "__buckets", "__fp", "__size"])
        give_back()

    return rows.mapInArrow(run, schema)


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of pairs (a, b: classes) whose texts (cls, text) are near copies."""

    def run(batches):
        for batch in batches:
            ok = [similarity(shingles(x), shingles(y)) >= SIMILAR for x, y in zip(blobs(batch.column("x")), blobs(batch.column("y")))]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def sketched(texts: DataFrame) -> DataFrame:
    """(cls, sketch: array of longs) of texts (cls, text)."""

    def run(batches):
        for b in batches:
            bits = [sketch(x).tolist() for x in blobs(b.column("text"))]
            yield pa.record_batch([b.column("cls"), pa.array(bits, pa.list_(pa.int64()))], names=["cls", "sketch"])

    return texts.select("cls", "text").mapInArrow(run, "cls long, sketch array<long>")


def _labels(links: DataFrame) -> DataFrame:
    """(cls, label) of all classes in links (a, b), label the smallest class reachable. Every class takes the label of its
    smallest neighbour, and links are drawn between labels, until all of them have one label at both ends."""
    label = written(links.select(F.explode(F.array("a", "b")).alias("cls")).distinct().withColumn("label", F.col("cls")))
    edges, drawn = links, None
    while True:
        low = written(edges.groupBy(F.col("b").alias("cls")).agg(F.min("a").alias("to")))
        up = low.select(F.col("cls").alias("to"), F.col("to").alias("above"))
        far = low
        for _ in range(2):
            far = far.join(up, "to", "left").select("cls", F.coalesce("above", "to").alias("to"))
        far = written(far)
        before, label = label, written(label.join(far.withColumnRenamed("cls", "label"), "label", "left").select("cls", F.coalesce("to", "label").alias("label")))
        of = lambda c: label.select(F.col("cls").alias(c), F.col("label").alias(f"label_{c}"))  # noqa: E731, B023
        ends = links.join(of("a"), "a").join(of("b"), "b").where("label_a <> label_b")
        old, drawn = drawn, written(ends.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")))
        discard(before, low, far, *([old] if old else []))
        edges = drawn
        if edges.isEmpty():
            discard(drawn)
            return label


def joined(classes: DataFrame, texts: DataFrame, first_pairs: DataFrame) -> DataFrame:
    """(node, component) of the classes (cls, buckets, size: shingles) that have a near copy. first_pairs (a, b): compared
    before others."""
    members = classes.select("cls", "size", "buckets", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("cls").alias("first")).where("n > 1").select("bucket", "first")
    left = written(members.join(shared, "bucket").select("bucket", "buckets", "cls", "size", "first"))
    met = left.select("cls").distinct()
    bits = written(sketched(texts.join(met, "cls", "left_semi")))
    left, plain = written(left.join(bits, "cls")), left
    discard(plain, bits)
    words = [F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("lead_sketch")[k])) for k in range(SKETCH // 64)]
    # Most pairs are told apart by the first bits; the rest is counted only for those that are left.
    alike = (sum(words[:FIRST_WORDS], F.lit(0)) <= differ(64 * FIRST_WORDS)) & (sum(words, F.lit(0)) <= differ(SKETCH))
    fits = F.least("size", "lead_size") >= SIMILAR * F.greatest("size", "lead_size") - 1e-9  # else even one set within the other is too unlike
    tested = texts.sparkSession.createDataFrame([], "a long, b long")
    made = []
    now, label = left.withColumn("label", F.col("cls")), None
    # A bucket's members are held against its first class, then against LEADS of them, then all. Classes of one label are
    # joined already; hardly one that belongs to a large group is left out of it when all are held against each other.
    for turn in ("one", "some", "all"):
        if label is not None:
            labelled = written(left.join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls")))
            mixed = written(labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low <> high").select("bucket", "n"))
            now = written(labelled.join(mixed, "bucket"))
            discard(labelled, mixed, left)
            left = now.drop("label", "n")
            if now.isEmpty():
                break
        lead = now
        if turn == "one":
            lead = now.where("cls = first")
        elif turn == "some":
            lead = now.where(F.pmod(F.xxhash64("cls", "bucket"), "n") < LEADS)
        lead = written(lead.select("bucket", F.col("buckets").alias("lead_buckets"), F.col("cls").alias("lead"), F.col("size").alias("lead_size"), F.col("sketch").alias("lead_sketch"), F.col("label").alias("of")))
        once = F.col("cls") > F.col("lead") if turn != "some" else F.col("cls") != F.col("lead")
        # In the last turn a pair is made in the first bucket that the two share, not in each: classes of different labels
        # share none that has been left out as of one label.
        here = F.array_intersect("buckets", "lead_buckets")[0] == F.col("bucket") if turn == "all" else F.lit(True)
        pairs = now.join(lead, "bucket").where((F.col("label") != F.col("of")) & once & fits & alike & here).select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b"))
        pairs = written((pairs.unionByName(first_pairs) if turn == "one" else pairs).distinct().join(tested, ["a", "b"], "left_anti"))
        discard(lead)
        links = written(_near(pairs, texts))
        tested = tested.unionByName(pairs)
        made += [pairs, links]
        if label is None:
            label = _labels(links)
        elif not links.isEmpty():
            before, label = label, _labels(label.select(F.col("label").alias("a"), F.col("cls").alias("b")).where("a <> b").unionByName(links))
            discard(before)
    discard(left, *made)
    return label.select(F.col("cls").alias("node"), F.col("label").alias("component"))


def chosen(docs: DataFrame, rows: DataFrame, named: DataFrame, done: tuple[DataFrame, ...]) -> DataFrame:
    """Of rows (signed) the best one of each component of named. done: tables that nothing else reads any more."""
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.sha2("text", 256).alias("digest"), "__row")
    least = rows.groupBy("__cls").agg(F.min(key).alias("best")).join(named.withColumnRenamed("node", "__cls"), "__cls", "left")
    best = written(least.groupBy(F.coalesce("component", "__cls").alias("group")).agg(F.min("best").alias("best")).select(F.col("best.__row").alias("__row")))
    discard(named, *done)
    return rows.join(best, "__row", "left_semi").select(docs.columns)
