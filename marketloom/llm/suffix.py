"""Removal of every byte that a repeated string of LENGTH bytes covers, by sparse prefix doubling.

Plain prefix doubling ranks every byte position at lengths 1, 2, 4, ... and sorts the pairs (rank at i, rank at i + n).
Here the same naming of positions by rank pairs runs over few of them. Within each LENGTH-byte window the position whose
GRAM-byte hash is least is the window's anchor; it depends on the window's bytes alone, so that equal windows have equal
anchors, and the windows of an anchor form a run. A run's first name is its gram; a run whose name is unique is done.
The compared length then grows: from the gram to the bytes that all windows of a block of the run share (its core), and
from there to single windows. At each step a name is the pair (name so far, hash of what was added), names are counted
by a grouped aggregate, unique ones drop out, and blocks whose whole extent is repeated are decided at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, discard, give_back, tuned, written

LENGTH, GRAM, BLOCK = 400, 100, 20
#: Bytes that are hashed at once; longer texts are cut, with LENGTH - 1 bytes of overlap.
BUFFER = 1 << 20
_POS = np.uint64(BUFFER * 2 - 1)
_FACTOR = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    out = np.full(BUFFER * 2, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP: list[np.ndarray] = []


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the gram at each position."""
    if not _UP:
        _UP.extend((_powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))))
    up, down = _UP
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * up[: len(buf)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(buf) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    pad = -len(x) % w
    blocks = np.concatenate([x, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - w + 1
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def runs(buf: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Of each run of windows with one anchor in the texts that end at ends: first and last window, anchor, gram hash."""
    h = gram_hashes(buf, gram)
    least = sliding_min(h & ~_POS | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    stop = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)]
    p = np.flatnonzero(np.arange(len(least)) + length <= stop)
    if not len(p):
        return (np.empty(0, np.int64),) * 4
    anchor = (least[p] & _POS).astype(np.int64)
    new = np.append(True, (np.diff(anchor) != 0) | (np.diff(p) != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return p[first], p[last], anchor[first], h[anchor[first]].view(np.int64)


def _name(data: bytes, seed: int = 0) -> tuple[int, int]:
    """128 bits as two signed longs."""
    x = xxhash.xxh3_128_digest(data, seed)
    return int.from_bytes(x[:8], "little", signed=True), int.from_bytes(x[8:], "little", signed=True)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that share d and th have the same text and so the same result."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("d"), F.xxhash64(text).alias("th"), text.alias("text"))


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), types)], names=names)


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """d, th, a (anchor), lo and hi (distances from window to anchor), g (gram), u1 and u2 (all bytes of the run)."""
    names, types = ["d", "th", "a", "lo", "hi", "g", "u1", "u2"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()] + [pa.int64()] * 3
    step = BUFFER - length

    def run(batches):
        for b in batches:
            cut = []  # (d, th, place in the text, bytes)
            for d, th, text in zip(b.column("d").to_pylist(), b.column("th").to_pylist(), blobs(b.column("text"))):
                cut += [(d, th, s, text[s : s + step + length - 1]) for s in range(0, max(1, len(text) - length + 1), step) if len(text) >= length]
            while cut:
                n = size = 0
                while n < len(cut) and (not n or size + len(cut[n][3]) <= BUFFER):
                    size += len(cut[n][3])
                    n += 1
                part, cut = cut[:n], cut[n:]
                data = b"".join(x[3] for x in part)
                ends = np.cumsum([len(x[3]) for x in part])
                first, last, anchor, g = runs(np.frombuffer(data, np.uint8), ends, length, gram)
                which = np.searchsorted(ends, first, side="right")
                rows = []
                for p, q, a, name, k in zip(first.tolist(), last.tolist(), anchor.tolist(), g.tolist(), which.tolist()):
                    d, th, s, text = part[k]
                    base = int(ends[k]) - len(text) - s
                    rows.append((d, th, a - base, a - q, a - p, name, *_name(data[p : q + length], (a - q) << 32 | a - p)))
                yield _batch(rows, names, types)
        give_back()

    return _keyed(docs).mapInArrow(run, "d long, th long, a int, lo int, hi int, g long, u1 long, u2 long")


def _refined(docs: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """Intervals (d, th, s, e) of repeated windows of reps with n = 1, found by growing the compared length."""
    block = min(BLOCK, max(1, length // 4))  # a core keeps most of a window
    lists = reps.select("d", "th", F.struct("a", "lo", "hi", "open").alias("x")).groupBy("d", "th").agg(F.collect_list("x").alias("runs"))

    def contexts(batches):
        for b in batches:
            rows = []
            for d, th, text, found in zip(b.column("d").to_pylist(), b.column("th").to_pylist(), blobs(b.column("text")), b.column("runs").to_pylist()):
                rows += [(d, th, x["a"], x["lo"], x["hi"], x["open"], text[x["a"] - x["hi"] : x["a"] - x["lo"] + length]) for x in found]
            yield _batch(rows, ["d", "th", "a", "lo", "hi", "open", "bytes"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()])

    texts = _keyed(docs).join(lists, ["d", "th"])
    held = written(texts.mapInArrow(contexts, "d long, th long, a int, lo int, hi int, open boolean, bytes binary").withColumn("id", F.struct("d", "th", "a", "lo")))  # lo: a run that a buffer's end has cut is two

    def blocks(batches):
        """A row for each block of a run: core and extent as names."""
        for b in batches:
            rows = []
            for id_, lo, hi, is_open, data in zip(*(b.column(c).to_pylist() for c in ("id", "lo", "hi", "open", "bytes"))):
                for k in range(lo // block, hi // block + 1):
                    t0, t1 = k * block, k * block + block - 1
                    c0, c1 = max(lo, t0), min(hi, t1)
                    rows.append((id_["d"], id_["th"], id_["a"], id_["lo"], is_open, c0, c1, *_name(data[hi - t0 : hi - t1 + length], k), *_name(data[hi - c1 : hi - c0 + length], c0 << 32 | c1)))
            yield _batch(rows, ["d", "th", "a", "lo", "open", "c0", "c1", "n1", "n2", "e1", "e2"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()] + [pa.int64()] * 4)

    first = held.select("id", "lo", "hi", "open", "bytes").mapInArrow(blocks, "d long, th long, a int, lo int, open boolean, c0 int, c1 int, n1 long, n2 long, e1 long, e2 long")
    named = written(first)
    # Names in Spark: extents that repeat are decided; of equal extents one stays as a partner for the others.
    extents = named.groupBy("n1", "n2", "e1", "e2").agg(F.count("*").alias("n"), F.min(F.struct("d", "th", "a", "lo")).alias("id"), F.max("open").alias("open"), F.first("c0").alias("c0"), F.first("c1").alias("c1"))
    extents = written(extents.withColumn("open", F.col("open") & (F.col("n") == 1)))
    cores = written(extents.groupBy("n1", "n2").agg(F.count("*").alias("m"), F.max("open").alias("some")).where("m > 1 and some"))
    decided = named.where("open").join(extents.where("n > 1").select("n1", "n2", "e1", "e2"), ["n1", "n2", "e1", "e2"])
    left = extents.join(cores.select("n1", "n2"), ["n1", "n2"]).select("id", "c0", "c1", F.col("open").alias("still"))

    def windows(batches):
        for b in batches:
            rows = []
            for id_, hi, data, c0, c1, still in zip(*(b.column(c).to_pylist() for c in ("id", "hi", "bytes", "c0", "c1", "still"))):
                rows += [(id_["d"], id_["th"], id_["a"] - t, still, *_name(data[hi - t : hi - t + length])) for t in range(c0, c1 + 1)]
            yield _batch(rows, ["d", "th", "s", "still", "w1", "w2"], [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()])

    # Equal rows of docs bring the same runs twice; none of those is open, so that it matters for the join alone.
    last = left.join(held.select("id", "hi", "bytes").dropDuplicates(["id"]), "id").select("id", "hi", "bytes", "c0", "c1", "still").mapInArrow(windows, "d long, th long, s int, still boolean, w1 long, w2 long")
    last = written(last)
    repeated = written(last.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.max("still").alias("some")).where("n > 1 and some").select("w1", "w2"))
    single = last.where("still").join(repeated, ["w1", "w2"]).select("d", "th", F.col("s").alias("s"), (F.col("s") + length).alias("e"))
    found = written(decided.select("d", "th", (F.col("a") - F.col("c1")).alias("s"), (F.col("a") - F.col("c0") + length).alias("e")).unionByName(single))
    discard(held, named, extents, cores, last, repeated)
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """d, th, spans (array of start << 32 | end): the repeated byte ranges of the texts that have any, unmerged."""
    tuned(docs.sparkSession)
    every = written(_runs(docs, length, gram))
    mixed = (F.min("u1") != F.max("u1")) | (F.min("u2") != F.max("u2"))
    grams = written(every.groupBy("g").agg(F.count("*").alias("n"), mixed.alias("mixed")).where("n > 1").select("g", "mixed"))
    shared = written(every.join(grams, "g"))
    discard(every, grams)
    whole = lambda df: df.select("d", "th", (F.col("a") - F.col("hi")).alias("s"), (F.col("a") - F.col("lo") + length).alias("e"))
    unlike = shared.where("mixed")
    alike = written(
        unlike.groupBy("u1", "u2").agg(F.count("*").alias("n"), F.min(F.struct("d", "th", "a", "lo", "hi")).alias("x")).select("u1", "u2", "x.*", (F.col("n") == 1).alias("open"))
    )
    copies = unlike.join(alike.where("not open").select("u1", "u2"), ["u1", "u2"])
    refined = _refined(docs, alike, length)
    found = whole(shared.where("not mixed")).unionByName(whole(copies)).unionByName(refined)
    packed = F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("e").cast("long"))
    spans = written(found.groupBy("d", "th").agg(F.collect_set(packed).alias("spans")))
    discard(shared, alike, refined)
    return spans


def _merged(packed) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in sorted(packed):
        s, e = x >> 32, x & 0xFFFFFFFF
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _within(docs: DataFrame, spans: DataFrame, length: int, gram: int) -> DataFrame:
    """The repeated spans of length bytes, looked for within spans, the repeated ones of fewer bytes.

    A repeated string's own parts repeat, so that it lies within a run of them, and so does each of its other places.
    """

    def regions(batches):
        for b in batches:
            rows = []
            for d, th, text, packed in zip(b.column("d").to_pylist(), b.column("th").to_pylist(), blobs(b.column("text")), b.column("spans").to_pylist()):
                rows += [(d, th, s, text[s:e]) for s, e in _merged(packed) if e - s >= length]
            yield _batch(rows, ["doc_id", "th", "at", "text"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()])

    cut_out = written(_keyed(docs).join(spans, ["d", "th"]).mapInArrow(regions, "doc_id long, th long, at int, text binary"))
    found = repeated_spans(cut_out, length, gram).withColumnRenamed("th", "region")
    placed = cut_out.select(F.col("doc_id").alias("d"), "th", "at", F.xxhash64("text").alias("region")).join(found, ["d", "region"])
    shift = F.col("at").cast("long")
    moved = placed.select("d", "th", F.explode(F.transform("spans", lambda x: x + F.shiftleft(shift, 32) + shift)).alias("x"))
    spans = written(moved.groupBy("d", "th").agg(F.collect_set("x").alias("spans")))
    discard(cut_out, found)
    return spans


#: Added by cut, and with a passage.
ADDED, PASSAGES = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], ["n_passages", "n_passage_bytes"]


def cut(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: int = 0, passage: tuple[int, int, int] | None = None) -> DataFrame:
    """All columns of docs, and n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left of the text).

    With words, a run of repeated bytes goes only if it holds at least so many words (split at white space; one that the
    run's end cuts counts). passage (bytes under length, gram, words) adds n_passages and n_passage_bytes: the runs of
    repeated strings of so many bytes that hold so many words, which are counted and not removed. A null text counts as
    empty; texts under length bytes stay whole, very long ones are hashed in parts that overlap; two equal rows remove
    each other's repeats, as any two documents do; an empty table gives no rows; other columns go through, those named
    like an added one are dropped.
    """
    ours, types = [*ADDED, *PASSAGES] if passage else ADDED, [pa.int64()] * 3 + [pa.string(), pa.binary()] + [pa.int64()] * 2 * bool(passage)
    named = lambda spans, name: spans.select(F.col("d").alias("__d"), F.col("th").alias("__th"), F.col("spans").alias(name))
    if passage:
        shorter = repeated_spans(docs, *passage[:2])
        spans = named(_within(docs, shorter, length, gram), "__spans").join(named(shorter, "__shorter"), ["__d", "__th"], "right")
    else:
        spans = named(repeated_spans(docs, length, gram), "__spans")
    base = docs.select([c for c in docs.columns if c not in (*ours, "__d", "__th", "__spans", "__shorter")])
    keys = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("__d"), F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("__th")]
    joined = base.select("*", *keys).join(spans, ["__d", "__th"], "left").drop("__d", "__th")
    schema = base.schema

    def run(batches):
        for b in batches:
            rows, none = [], [None] * b.num_rows
            shorter = b.column("__shorter").to_pylist() if passage else none
            for text, packed, some in zip(blobs(b.column("text")), b.column("__spans").to_pylist(), shorter):
                ranges = [(s, e) for s, e in _merged(packed or ()) if not words or len(text[s:e].split()) >= words]
                at, kept = 0, []
                for s, e in ranges:
                    kept.append(text[at:s])
                    at = e
                kept = b"".join([*kept, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest(), kept))
                if passage:
                    sizes = [e - s for s, e in _merged(some or ()) if len(text[s:e].split()) >= passage[2]]
                    rows[-1] += (len(sizes), sum(sizes))
            own = _batch(rows, ours, types)
            cols = [b.column(c) for c in schema.names] + own.columns
            yield pa.record_batch(cols, names=[*schema.names, *ours])

    kept_schema = type(schema)(list(schema.fields)).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept", "binary")
    for name in PASSAGES if passage else ():
        kept_schema = kept_schema.add(name, "long")
    return joined.mapInArrow(run, kept_schema)


def as_text(kept: F.Column) -> F.Column:
    """Bytes as text, without the parts of characters that a cut has left."""

    @F.pandas_udf("string")
    def decoded(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else bytes(v).decode("utf-8", "ignore"))

    return decoded(kept)
