"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints are sorted by their rank in the Gray sequence and cut into ranges. A node of the index holds the bits that
all fingerprints below it share (mask, pattern); a child keeps only the shared bits its parent does not have, so that
differences add up on the way down and a whole group is left as soon as they pass the radius. The index over the ranges'
top nodes says which ranges a fingerprint has to visit; each range is searched by a task of its own with its own index.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import nearcopies
from .common import aside, blobs, components, give_back, local_components, tuned, written

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Fingerprints in a range, at least (few large ranges: a fingerprint visits about 1 + b + b (b - 1) / 2 of 2 ** b ranges); ranges, at most (their top nodes go to every task: 16 bytes each); visitors in a task.
RANGE_ROWS, RANGES, VISITORS, FAN = 1 << 16, 1 << 15, 500_000, 16


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 of all 3-word shingles; fewer words make one shingle, none make 0."""
    words = text.lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) >= SHINGLE else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(g, SEED) for g in grams), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    total, n = np.zeros(64, np.int64), 0
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long: the 64 bits). A null text counts as empty."""
    tuned(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(x) for x in blobs(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(fps)})
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place in the Gray sequence."""
    x = x.view(np.uint64).copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Leaves (pattern, mask) in Gray order under levels of FAN children each."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray | None = None):
        full = np.full(len(pattern), ~np.uint64(0)) if mask is None else mask
        levels = [(pattern, full)]
        while len(levels[-1][0]) > FAN:
            p, m = levels[-1]
            starts = np.arange(0, len(p), FAN)
            differ = np.bitwise_or.reduceat(p ^ np.repeat(p[starts], FAN)[: len(p)], starts)
            shared = np.bitwise_and.reduceat(m, starts) & ~differ
            levels.append((p[starts] & shared, shared))
        self.levels = []
        for k, (p, m) in enumerate(levels):
            above = np.repeat(levels[k + 1][1], FAN)[: len(p)] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((p, m & ~above))

    def search(self, queries: np.ndarray, radius: int):
        """Yields arrays (place of the query, place of the leaf) that differ in radius shared bits at most."""
        step = 1024
        for i in range(0, len(queries), step):
            part = queries[i : i + step]
            p, m = self.levels[-1]
            q, node = np.repeat(np.arange(len(part)), len(p)), np.tile(np.arange(len(p)), len(part))
            gone = np.bitwise_count((part[q] ^ p[node]) & m[node])
            q, node, gone = (x[gone <= radius] for x in (q, node, gone))
            for p, m in self.levels[-2::-1]:
                q, gone = np.repeat(q, FAN), np.repeat(gone, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(p)
                q, node, gone = q[there], node[there], gone[there]
                gone = gone + np.bitwise_count((part[q] ^ p[node]) & m[node])
                q, node, gone = (x[gone <= radius] for x in (q, node, gone))
            yield q + i, node


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between fingerprints (a spanning forest of each task's links). fps: distinct, column fp, written."""
    n = fps.count()
    size = max(RANGE_ROWS, math.ceil(n / RANGES))
    parts = max(1, math.ceil(n / size))

    def ranked(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            yield pa.record_batch({"fp": pa.array(fp), "rank": pa.array((gray_rank(fp) >> np.uint64(1)).view(np.int64))})

    order = fps.select("fp").mapInArrow(ranked, "fp long, rank long")
    cuts = np.array(sorted(set(order.approxQuantile("rank", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else [], float)

    def placed(batches):
        for b in batches:
            home = np.searchsorted(cuts, b.column("rank").to_numpy(zero_copy_only=False).astype(float), side="right")
            yield pa.record_batch({"fp": b.column("fp"), "home": pa.array(home.astype(np.int32))})

    homes = order.mapInArrow(placed, "fp long, home int")
    tops = homes.groupBy("home").agg(F.bit_and("fp").alias("all"), F.bit_or("fp").alias("any")).orderBy("home").collect()
    key = np.array([r["home"] for r in tops], np.int32)
    low, high = (np.array([r[c] for r in tops], np.int64).view(np.uint64) for c in ("all", "any"))
    shared = ~(low ^ high)

    def routed(batches):
        index = GrayIndex(low & shared, shared)
        for b in batches:
            fp, home = b.column("fp").to_numpy(zero_copy_only=False), b.column("home").to_numpy(zero_copy_only=False)
            for q, t in index.search(fp.view(np.uint64), radius):
                later = key[t] >= home[q]  # a pair of ranges is searched once
                yield pa.record_batch({"part": pa.array(key[t[later]]), "fp": pa.array(fp[q[later]]), "own": pa.array(key[t[later]] == home[q[later]])})

    visits = written(homes.mapInArrow(routed, "part int, fp long, own boolean"))
    # A range with more visitors than a task should hold is searched by several, each with all of its members.
    many = {r["part"]: math.ceil(r["n"] / VISITORS) for r in visits.where("not own").groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > VISITORS).collect()}
    if many:
        copies = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in many.items() for x in kv]), F.col("part")), F.lit(1))
        visits = visits.withColumn("shares", copies).withColumn(
            "share", F.explode(F.when(F.col("own"), F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array(F.pmod(F.hash("fp"), F.col("shares")))))
        )
    else:
        visits = visits.withColumn("share", F.lit(0))

    def search(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        own = group.column("own").to_numpy(zero_copy_only=False).astype(bool)
        members = fp[own]
        members = members[np.argsort(gray_rank(members), kind="stable")]
        first = group.column("share")[0].as_py() == 0
        asked = fp if first else fp[~own]
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(members):
            for q, t in GrayIndex(members).search(asked, radius):
                x, y = asked[q].view(np.int64), members[t].view(np.int64)
                keep = x != y
                # A forest keeps what the links join, in no more rows than there are fingerprints.
                nodes, heads = local_components(np.append(a.pop(), x[keep]), np.append(b.pop(), y[keep]))
                keep = nodes != heads
                a.append(nodes[keep])
                b.append(heads[keep])
        return pa.table({"a": a[0], "b": b[0]})

    return visits.select("part", "share", "fp", "own").groupBy("part", "share").applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id. Very long texts are hashed whole.

    Fingerprints that differ in at most radius bits are linked; component_id is the smallest doc_id reachable.
    Null and empty texts have fingerprint zero and link like any other; equal rows stay as they are, each with the same
    result; an empty table gives no rows; other columns are not looked at. A null doc_id never names a component.
    """
    rows = written(fingerprints(docs))
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("head")))
    joined = components(links(fps, radius))
    heads = written(fps.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = written(heads.groupBy("component").agg(F.min("head").alias("component_id")))
    named = heads.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near copies: five-word shingles, a Jaccard similarity of 0.8 or more.

    Fingerprints of the shingles are linked through the index as in near_duplicates, and each link is confirmed by the
    exact similarity of the two texts. Texts of a similarity of 0.8 differ in ten of 64 bits, which no such index reaches:
    what is left over is brought together by min-hashes and confirmed alike (nearcopies). Of a group the row with the
    smallest doc_id stays, of equal ids the one whose text has the smallest digest. Rows are chosen by themselves and not
    by doc_id: a null doc_id, or one that other texts have too, is no reason to go; null ids come last. Null and empty
    texts are copies of each other. An empty table gives no rows; all columns go through, whatever their names.
    """
    tuned(docs.sparkSession)
    docs, back = aside(docs, "doc_id", "text")
    rows = written(nearcopies.signed(docs, majority))
    classes = written(rows.groupBy("__cls").agg(F.min("__row").alias("row"), F.min("__buckets").alias("buckets"), F.min("__fp").alias("fp"), F.min("__size").alias("size")).withColumnRenamed("__cls", "cls"))
    texts = rows.join(classes.select(F.col("row").alias("__row")), "__row", "left_semi").select(F.col("__cls").alias("cls"), "text")
    heads = written(classes.groupBy("fp").agg(F.min("cls").alias("head")))
    alike = classes.join(heads, "fp").where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))
    head = lambda c: heads.select(F.col("fp").alias(c), F.col("head").alias(f"head_{c}"))
    linked = links(heads.select("fp"), radius).join(head("a"), "a").join(head("b"), "b").select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b"))
    named = nearcopies.joined(classes.select("cls", "buckets", "size"), texts, alike.unionByName(linked))
    return back(nearcopies.chosen(docs, rows, named, (classes, heads)))
