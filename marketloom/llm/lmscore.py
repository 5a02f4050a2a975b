"""Cross-entropy difference of documents under two matched bigram models.

A target model and a background model have the same order, smoothing and vocabulary, which is every word of either; the
score of a document is the mean over its words of the target's loss less the background's. The loss of a word after
another parts into what the pair and the word decide and what the first word decides, so that all counts can stay where
they are made: each occurrence is dealt out by its word, and the task that sums a word's and its pairs' counts over the
whole corpus also scores its occurrences; each document's sums are then put together. No table of words is ever in one
place. Words that make up a large part of the corpus are few by their rate: their counts are known everywhere, and what
follows them is dealt out by pairs; frequent pairs of two such words are scored where the document is read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, blobs, give_back, tuned, written

#: Rate of words that are known everywhere (at most 1 / HOT of them), and of pairs of these that are scored at once.
HOT, PAIR = 1e-4, 1e-5
#: Weight of the unigram model in the bigram model, in words; added to each word's count.
PRIOR, ADDED = 20.0, 0.5
#: Words between sends; words of a task's share. On a large corpus the rates sink, so that no word or pair that is dealt
#: out by itself makes up more than half a share.
CHUNK, SHARE = 2_000_000, 1_000_000
#: Stand for the start of a text, and for a text's last word taken back as a first one. Words' names are odd.
_START, _LAST = 0, 2


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _name(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) | 1


class Namer(Memo):
    """64-bit names of words; words that were named lately are remembered."""

    def __init__(self):
        super().__init__(_name)

    def ids(self, text: bytes) -> np.ndarray:
        words = _words(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words)).view(np.int64)


def _counted(rows: DataFrame) -> DataFrame:
    """(word, nb, nt): counts of words, by name, in the background and the target. rows: text, target."""

    def run(batches):
        seen = (Counter(), Counter())

        def send():
            words = [*(seen[0].keys() | seen[1].keys())]
            names = np.fromiter(map(_name, words), np.uint64, len(words)).view(np.int64)
            yield pa.record_batch({"word": pa.array(names), "nb": pa.array([seen[0][w] for w in words], pa.int64()), "nt": pa.array([seen[1][w] for w in words], pa.int64())})
            for s in seen:
                s.clear()

        for b in batches:
            for text, target in zip(blobs(b.column("text")), b.column("target").to_pylist()):
                seen[target].update(_words(text))
            if len(seen[0]) > 400_000:
                yield from send()
        yield from send()
        give_back()

    return rows.mapInArrow(run, "word long, nb long, nt long").groupBy("word").agg(F.sum("nb").alias("nb"), F.sum("nt").alias("nt"))


class Known:
    """The hot words, the start of a text among them, and what both models share. Rows: background, target."""

    def __init__(self, names: np.ndarray, counts: np.ndarray, totals: np.ndarray, size: int):
        order = np.argsort(names)
        self.names, self.counts, self.totals, self.size = names[order], counts[:, order].astype(float), totals, size

    def place(self, ids: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if it isn't hot."""
        at = np.minimum(np.searchsorted(self.names, ids), len(self.names) - 1)
        return np.where(self.names[at] == ids, at, -1)

    def after(self, pairs: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        """The part of the loss that the pair and its second word decide, from their counts."""
        unigram = (seconds + ADDED) / (self.totals[:, None] + ADDED * self.size)
        return -np.log(pairs + PRIOR * unigram)

    def before(self, firsts: np.ndarray) -> np.ndarray:
        """The part that the first word decides, from its counts."""
        return np.log(firsts + PRIOR)


def _sent(kind: int, part: np.ndarray, *columns: np.ndarray):
    """One row for each part: the columns of its entries as bytes."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.append(True, np.diff(part) != 0)) if len(part) else np.empty(0, int)
    ends = np.append(cuts[1:], len(part))
    columns = [c[order] for c in columns]
    blob = [b"".join(c[i:j].tobytes() for c in columns) for i, j in zip(cuts, ends)]
    return pa.record_batch({"part": pa.array(part[cuts].astype(np.int32)), "kind": pa.array([kind] * len(cuts), pa.int32()), "n": pa.array(ends - cuts, pa.int64()), "data": pa.array(blob, pa.binary())})


def _opened(n: int, data: bytes, *types: str) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _mixed(x: np.ndarray, parts: int) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ x >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ x >> np.uint64(29)).view(np.int64)


_PART = "part int, kind int, n long, data binary"


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, loss_target, loss_background, score (their difference; lower: more like the target).

    A row for each row of docs; losses are means over the words in nats. A null or empty text has no words and score 0;
    an empty target gives a model of nothing but smoothing; texts that occur twice count twice; very long texts are
    scored whole; an empty table gives no rows; columns other than the id and the text are not looked at, whatever their
    names. No word is left out of the vocabulary; two words are one if their 63-bit hashes are.
    """
    spark = tuned(docs.sparkSession)
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).alias("target")).unionByName(
        target.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(1).alias("target"))
    )
    words = written(_counted(both.select("text", "target")))
    sums = words.agg(F.sum("nb"), F.sum("nt"), F.count("*")).first()
    totals = np.array([sums[0] or 0, sums[1] or 0], float)
    texts = both.groupBy("target").count().collect()
    texts = np.array([sum(r["count"] for r in texts if r["target"] == k) for k in (0, 1)], float)
    most = SHARE / 2 / max(1.0, totals.sum())
    hot = words.where(F.col("nb") + F.col("nt") >= max(1, min(HOT, most) * totals.sum())).toPandas()
    known = Known(np.append(hot["word"].to_numpy(np.int64), _START), np.concatenate([hot[["nb", "nt"]].to_numpy(float).T, texts[:, None]], axis=1), totals, sums[2] + 1)
    shared = spark.sparkContext.broadcast(known)
    parts = max(8, math.ceil(totals.sum() / SHARE))

    def frequent(batches):
        """Counts of the pairs of two hot words, by their places."""
        known, namer, keys, of, size = shared.value, Namer(), [], [], 0

        def send():
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            target = np.concatenate(of)
            n = [np.bincount(at[target == k], minlength=len(key)) for k in (0, 1)]
            yield pa.record_batch({"pair": pa.array(key), "nb": pa.array(n[0]), "nt": pa.array(n[1])})
            keys.clear()
            of.clear()

        for b in batches:
            for text, target in zip(blobs(b.column("text")), b.column("target").to_pylist()):
                at = known.place(np.append(_START, namer.ids(text)))
                pair = (at[:-1] << 32 | at[1:])[(at[:-1] >= 0) & (at[1:] >= 0)]
                keys.append(pair)
                of.append(np.full(len(pair), target, np.int8))
                size += len(pair)
            if size > CHUNK:
                yield from send()
                size = 0
        if keys:
            yield from send()
        give_back()

    counted = both.select("text", "target").mapInArrow(frequent, "pair long, nb long, nt long").groupBy("pair").agg(F.sum("nb").alias("nb"), F.sum("nt").alias("nt"))
    common = counted.where(F.col("nb") + F.col("nt") >= max(1, min(PAIR, most) * totals.sum())).orderBy("pair").toPandas()
    pair = common["pair"].to_numpy(np.int64)
    loss = known.after(common[["nb", "nt"]].to_numpy(float).T, known.counts[:, pair & 0xFFFFFFFF]) if len(pair) else np.empty((2, 0))
    shared_pairs = spark.sparkContext.broadcast((np.append(pair, np.iinfo(np.int64).max), np.concatenate([loss, np.zeros((2, 1))], axis=1)))

    def dealt(batches):
        """Sums over what is known here by document (kind 1), all other occurrences (kind 0)."""
        known, (common, loss), namer = shared.value, shared_pairs.value, Namer()
        before = known.before(known.counts)
        row, size = TaskContext.get().partitionId() << 36, 0
        firsts, seconds, rows_, by_pair, told = [], [], [], [], []

        def send():
            nonlocal size
            first, second, of, paired = (np.concatenate(x) for x in (firsts, seconds, rows_, by_pair))
            order = np.lexsort((of, first, second))
            first, second, of, paired = first[order], second[order], of[order], paired[order]
            new = np.append(True, (np.diff(second) != 0) | (np.diff(first) != 0) | (np.diff(of) != 0)) if len(of) else np.empty(0, bool)
            n = np.diff(np.append(np.flatnonzero(new), len(of))).astype(np.uint32)
            first, second, of, paired = first[new], second[new], of[new], paired[new]
            part = np.where(paired, _mixed(second ^ _scrambled(first), parts), _mixed(second, parts))
            yield _sent(0, part, first, second, of, n)
            info = np.array(told, [("row", "<i8"), ("doc", "<i8"), ("null", "?"), ("n", "<i8"), ("b", "<f8"), ("t", "<f8")])
            yield _sent(1, _mixed(info["row"], parts), *(info[c].copy() for c in info.dtype.names))
            for x in (firsts, seconds, rows_, by_pair, told):
                x.clear()
            size = 0

        for b in batches:
            for doc, text, target in zip(b.column("doc_id").to_pylist(), blobs(b.column("text")), b.column("target").to_pylist()):
                row += 1
                ids = np.append(_START, namer.ids(text))
                place = known.place(ids)
                first, second, a, z = ids[:-1], ids[1:], place[:-1], place[1:]
                key = a << 32 | z
                at = np.searchsorted(common, key)
                hit = (a >= 0) & (z >= 0) & (common[at] == key)
                if not target:
                    told.append((row, doc or 0, doc is None, len(second), *(loss[:, at[hit]].sum(axis=1) + before[:, a[a >= 0]].sum(axis=1))))
                    if len(second) and z[-1] < 0:  # no word comes after the last one
                        first, second, hit, z = np.append(first, _LAST), np.append(second, second[-1]), np.append(hit, False), np.append(z, -1)
                firsts.append(first[~hit])
                seconds.append(second[~hit])
                by_pair.append(z[~hit] >= 0)
                rows_.append(np.full(int((~hit).sum()), -row if target else row, np.int64))
                size += len(second)
            if size > CHUNK:
                yield from send()
        if rows_:
            yield from send()
        give_back()

    def summed(group: pa.Table) -> pa.Table:
        """Counts of each word and pair over the corpus, and the losses of their occurrences by document."""
        known, out, found = shared.value, [], []
        for kind, n, data in zip(*(group.column(c).to_pylist() for c in ("kind", "n", "data"))):
            if kind:
                out.append({"part": group.column("part")[0].as_py(), "kind": 1, "n": n, "data": data})
            else:
                found.append(_opened(n, data, "<i8", "<i8", "<i8", "<u4"))
        tables = [pa.Table.from_pylist(out, pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("data", pa.binary())]))]
        if found:
            first, second, row, n = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((first, second))
            first, second, row, n = first[order], second[order], row[order], n[order].astype(float)
            new_word = np.append(True, np.diff(second) != 0)
            word, pair = np.cumsum(new_word) - 1, np.cumsum(new_word | np.append(True, np.diff(first) != 0)) - 1
            last, place = first == _LAST, known.place(second)
            sides = [m & ~last for m in (row > 0, row < 0)]
            pairs = np.stack([np.bincount(pair[m], n[m], pair[-1] + 1)[pair] for m in sides])
            counts = np.stack([np.bincount(word[m], n[m], word[-1] + 1)[word] for m in sides])
            counts = np.where(place >= 0, known.counts[:, np.maximum(place, 0)], counts)
            loss = np.where(last, 0, known.after(pairs, counts)) + np.where(place >= 0, 0, np.where(last, -1, 1) * known.before(counts))
            own = row > 0
            doc, of = np.unique(row[own], return_inverse=True)
            sums = [np.bincount(of, loss[k, own] * n[own], len(doc)) for k in (0, 1)]
            tables.append(pa.Table.from_batches([_sent(2, _mixed(doc, parts), doc, *sums)]))
        return pa.concat_tables(tables)

    def finished(group: pa.Table) -> pa.Table:
        info, sums = [], []
        for kind, n, data in zip(*(group.column(c).to_pylist() for c in ("kind", "n", "data"))):
            if kind == 1:
                info.append(_opened(n, data, "<i8", "<i8", "?", "<i8", "<f8", "<f8"))
            else:
                sums.append(_opened(n, data, "<i8", "<f8", "<f8"))
        if not info:
            return pa.table({c: pa.array([], t) for c, t in (("doc_id", pa.int64()), ("n_words", pa.int64()), ("loss_target", pa.float64()), ("loss_background", pa.float64()), ("score", pa.float64()))})
        row, doc, null, n, b, t = (np.concatenate(x) for x in zip(*info))
        order = np.argsort(row)
        row, doc, null, n, b, t = (x[order] for x in (row, doc, null, n, b, t))
        if sums:
            of, mb, mt = (np.concatenate(x) for x in zip(*sums))
            at = np.searchsorted(row, of)
            b, t = b + np.bincount(at, mb, len(row)), t + np.bincount(at, mt, len(row))
        per = np.maximum(n, 1)
        return pa.table({"doc_id": pa.array(doc, mask=null), "n_words": pa.array(n), "loss_target": pa.array(t / per), "loss_background": pa.array(b / per), "score": pa.array((t - b) / per)})

    sent = both.mapInArrow(dealt, _PART).groupBy("part").applyInArrow(summed, _PART)
    return sent.groupBy("part").applyInArrow(finished, "doc_id long, n_words long, loss_target double, loss_background double, score double")
