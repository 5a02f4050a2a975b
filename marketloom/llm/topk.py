"""Exact top-k inner-product search by the threshold algorithm.

Vectors are dealt into shards and queries into blocks; a task holds one of each. A shard keeps, for each dimension, its
vectors sorted by that component; a query reads the lists from the end that its sign favours. What no list has shown by
some depth cannot score more than the query's product with the components at that depth. The first rows read give a kth
score to beat, and the lists are read to the first depth whose bound is below it. Where that depth shows as many entries
as there are vectors, all rows are scored at once. The shards' answers are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tuned, written

#: Vectors in a shard; queries in a block; depth of the first reading; queries scored at once.
SHARD, QUERIES, FIRST, ROWS = 4096, 8192, 4, 64


def quantized(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x). Products stay exact: as doubles where they can be, else as integers of any size."""
    return np.floor(scale * x.astype(np.float64))


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    largest = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 2**53:
        return a, b
    return tuple(np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b))


def threshold_search(ids: np.ndarray, c: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """Yields (place of the query, ids, scores, rows scored) of its k best rows of c, rows with the query's own id left out."""
    m, d = c.shape
    order = np.argsort(c, axis=0, kind="stable") if c.dtype != object else np.array([sorted(range(m), key=lambda i: c[i, j]) for j in range(d)]).T
    lists = np.take_along_axis(c, order, axis=0)
    depths = np.unique(np.minimum(m - 1, [FIRST << j for j in range(max(1, m.bit_length()))]))
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    # What a row that no list has shown down to depth t can score at most.
    bounds = np.stack([up @ lists[m - 1 - t] + down @ lists[t] for t in depths], axis=1)
    used = (q != 0).sum(axis=1)
    # First reading, for all queries together: both ends of every list.
    n_first = min(FIRST, m)
    read = np.unique(np.concatenate([order[m - n_first :].ravel(), order[:n_first].ravel()]))
    need = np.full(len(q), m)
    for j in range(0, len(q), ROWS if len(read) > k + 1 else len(q) + 1):
        part = slice(j, j + ROWS)
        if len(read) <= k + 1:
            break
        scores = q[part] @ c[read].T
        if scores.dtype == object:
            break
        scores[query_ids[part, None] == ids[read]] = -np.inf
        kth = np.partition(scores, len(read) - k, axis=1)[:, len(read) - k]
        below = bounds[part] < kth[:, None]  # a row that ties with the kth score counts, and so the bound must be below it
        need[part] = np.where(below.any(axis=1), depths[below.argmax(axis=1)] + 1, m)
    whole = (need >= m) | (need * used >= m)  # a query of zeros has no list, and no depth is enough
    for i in np.flatnonzero(~whole).tolist():
        t, pos, neg = int(need[i]), np.flatnonzero(q[i] > 0), np.flatnonzero(q[i] < 0)
        rows = np.unique(np.concatenate([order[m - t :, pos].ravel(), order[:t, neg].ravel(), read]))
        rows = rows[ids[rows] != query_ids[i]]
        yield (i, *_top(ids[rows], c[rows] @ q[i], k), len(rows))
    whole = np.flatnonzero(whole)
    for j in range(0, len(whole), ROWS):
        part = whole[j : j + ROWS]
        scores = q[part] @ c.T
        if scores.dtype != object and m > 4 * k:  # of ties with the (k + 1)th all stay; the query's own row may be among them
            floor = np.partition(scores, m - k - 1, axis=1)[:, m - k - 1]
            picks = [np.flatnonzero(s >= f) for s, f in zip(scores, floor)]
        else:
            picks = [np.arange(m)] * len(part)
        for i, s, rows in zip(part.tolist(), scores, picks):
            rows = rows[ids[rows] != query_ids[i]]
            yield (i, *_top(ids[rows], s[rows], k), m)


def _top(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if score.dtype == object:
        pick = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k]
    else:
        pick = np.lexsort((ids, -score))[:k]
    return ids[pick], score[pick]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score. vectors, queries: vec_id, embedding.

    A query's own row (its vec_id) is no candidate; ties go to the smaller vec_id; fewer than k candidates give fewer
    rows. Vectors that are null or empty, or hold null or non-finite components, and null ids take no part; vectors are
    compared with those of their own length; rows that repeat an id and a vector count once; scores beyond a long are
    cut to its range. Empty tables give no rows.
    """
    spark = tuned(vectors.sparkSession)
    fine = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where(
        "vec_id is not null and size(x) > 0 and forall(x, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
    )
    rows, asked = written(fine(vectors).dropDuplicates(["vec_id", "x"])), written(fine(queries).dropDuplicates(["vec_id", "x"]))
    shards, blocks = max(1, math.ceil(rows.count() / SHARD)), max(1, math.ceil(asked.count() / QUERIES))
    deal = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    both = rows.select(F.size("x").alias("d"), deal(1, shards).alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), "vec_id", "x").unionByName(
        asked.select(F.size("x").alias("d"), every(shards).alias("shard"), deal(2, blocks).alias("block"), F.lit(True).alias("asks"), "vec_id", "x")
    )
    long = (-(1 << 63), (1 << 63) - 1)

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids = group.column("vec_id").to_numpy()
        x = group.column("x").combine_chunks()
        x = quantized(x.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1), scale)
        out = [[], [], []]
        if asks.any() and not asks.all():
            c, q = _exact(x[~asks], x[asks])
            query_ids = ids[asks]
            for i, found, score, _ in threshold_search(ids[~asks], c, query_ids, q, k):
                out[0].append(np.full(len(found), query_ids[i]))
                out[1].append(found)
                out[2].append(np.array([min(max(int(s), long[0]), long[1]) for s in score.tolist()], np.int64))
        cols = [np.concatenate(o) if o else np.empty(0, np.int64) for o in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    found = both.groupBy("d", "shard", "block").applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
