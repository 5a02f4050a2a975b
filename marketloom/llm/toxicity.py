"""Toxicity by weak supervision.

Lexicon voters (words and word beginnings, a seed list and those that the training labels bring out) and pattern voters
vote on documents. A generative label model estimates by EM how often each voter fires on toxic and on other documents,
and which voters repeat each other; its posterior labels train a linear classifier, which scores every document.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, tuned, written

#: Labelled documents that voters are mined from and the classifier is fitted on, at most: a sample by hash. All other
#: documents outside the held-out fold take part in the label model without a label. Voters, at most; documents a voter must
#: fire on; letters of the beginnings that vote; letters of the words that a worker remembers (longer ones vote as well).
MAX_LABELLED, MAX_VOTERS, LEAST_DOCS = 20_000, 160, 4
PREFIXES, REMEMBERED = range(3, 9), 64
#: Rounds of the label model over all documents, which start from what the labelled sample says.
ROUNDS = 8
#: Tasks that add up the sums of others.
FEW = 8
#: How often a label is taken to be right, at most: it is a strong voter among others, and not the truth.
TRUST = 0.98
#: Plain insults, as seed voters.
SEED = (
    "idiot moron stupid scum trash loser worthless pathetic disgusting clown dumb imbecile jerk bastard vermin filth "
    "idiote crétin connard salaud ordure trottel arschloch abschaum dummkopf imbécil estúpido basura escoria"
).split()
PATTERNS = (r"(?i)\b(?:shut up|go to hell|kill yourself|i hate you|hate you all)\b", r"(?i)\byou (?:are|re) (?:a |an |so |such )*(?:%s)" % "|".join(SEED[:16]))
_WORD = re.compile(r"\w+")
_PATTERNS = [re.compile(p) for p in PATTERNS]


def features_of(word: str) -> list[str]:
    return ["=" + word, *(word[:k] for k in PREFIXES if len(word) > k)]


class _Memo(dict):
    """Word to the voters that fire on it; forgets when it has grown large."""

    def __init__(self, voters):
        super().__init__()
        self.place = {v: k for k, v in enumerate(voters)}

    def __missing__(self, word):
        got = tuple(self.place[f] for f in features_of(word) if f in self.place)
        if len(self) > 150_000:
            self.clear()
        if len(word) < REMEMBERED:
            self[word] = got
        return got


def _counts(text: str, memo: _Memo, n_voters: int) -> tuple[np.ndarray, int]:
    words = _WORD.findall(text.lower())
    x = np.zeros(n_voters + len(_PATTERNS))
    for got in filter(None, map(memo.__getitem__, words)):
        for k in got:
            x[k] += 1
    for k, p in enumerate(_PATTERNS):
        if p.search(text):
            x[n_voters + k] = len(p.findall(text))
    return x, len(words)


@dataclass
class Model:
    voters: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, texts) -> np.ndarray:
        key, out = tuple(self.voters), np.empty(len(texts))
        if key not in _MEMOS:  # a worker outlives its model: it keeps the last one's words only
            _MEMOS.clear()
            _MEMOS[key] = _Memo(self.voters)
        memo = _MEMOS[key]
        for i, text in enumerate(texts):
            x, n = _counts(text or "", memo, len(self.voters))
            out[i] = self.lean(x, n)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))

    def lean(self, x: np.ndarray, n: int) -> float:
        return float(_rows(x[None], np.array([n]))[0] @ self.weights + self.bias) if x.any() else self.bias


_MEMOS: dict = {}


def _rows(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Presence, log count and density of each voter."""
    return np.hstack([x > 0, np.log1p(x), np.minimum(1, 20 * x / np.maximum(n, 1)[:, None])]).astype(np.float32)


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxic for each row, and each voter's rates of firing (on toxic, on other) and its share of a vote.

    gold (0, 1, or -1 for a row without a label) is one more voter, whose rate of being right is estimated like the
    others', up to TRUST. The correlations of the voters given the label are estimated from what the rates leave over:
    a voter that others repeat counts once among them, by the sum of the squared correlations.
    """
    labelled = gold >= 0
    trust = 0.9
    # Rows without a label begin with what the voters say whose rates the labelled rows give.
    post = np.where(gold == 1, 0.9, np.where(gold == 0, 0.1, 0.0))
    fit = labelled.astype(float)
    share = np.ones(votes.shape[1])
    for k in range(rounds):
        on_w, off_w = fit * post, fit * (1 - post)
        p = float(np.clip(on_w.sum() / fit.sum(), 1e-4, 1 - 1e-4))
        on = (on_w @ votes + 0.5) / (on_w.sum() + 1)
        off = (off_w @ votes + 0.5) / (off_w.sum() + 1)
        if k % 8 == 3:  # once the rates are sensible, and again as they change
            left = votes - np.outer(post, on).astype(votes.dtype) - np.outer(1 - post, off).astype(votes.dtype)
            sd = np.sqrt((left**2).mean(axis=0)) + 1e-9
            share = 1 / ((left.T @ left / len(votes) / np.outer(sd, sd)) ** 2).sum(axis=1)
        lean = votes @ (share * np.log(on / off)) + (1 - votes) @ (share * np.log((1 - on) / (1 - off)))
        lean += np.log(p / (1 - p)) + np.where(labelled, np.where(gold == 1, 1, -1) * np.log(trust / (1 - trust)), 0)
        post = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
        fit = np.ones(len(gold))
        trust = float(np.clip(np.where(gold == 1, post, 1 - post)[labelled].mean(), 0.6, TRUST))
    return post, np.stack([on, off]), share


@dataclass
class Rates:
    """What the label model has learned: the rate of toxic, of each voter's firing on toxic and on other documents, each
    voter's share of a vote, and how often a label is right."""

    p: float
    on: np.ndarray
    off: np.ndarray
    share: np.ndarray
    trust: float

    def posterior(self, votes: np.ndarray, gold: np.ndarray) -> np.ndarray:
        lean = votes @ (self.share * np.log(self.on / self.off)) + (1 - votes) @ (self.share * np.log((1 - self.on) / (1 - self.off)))
        lean += np.log(self.p / (1 - self.p)) + np.where(gold >= 0, np.where(gold == 1, 1, -1) * np.log(self.trust / (1 - self.trust)), 0)
        return 1 / (1 + np.exp(-np.clip(lean, -30, 30)))


def _first_rates(votes: np.ndarray, gold: np.ndarray) -> Rates:
    """The label model over the labelled sample alone."""
    post, (on, off), share = label_model(votes, gold)
    right = np.where(gold == 1, post, 1 - post).mean()
    return Rates(float(np.clip(post.mean(), 1e-4, 1 - 1e-4)), on, off, share, float(np.clip(right, 0.6, TRUST)))


def _next_rates(patterns: DataFrame, r: Rates, repeats: bool) -> Rates:
    """A round of EM over all documents. patterns: bits of the votes, gold, n (how many documents). Tasks sum what the rates
    need, and with repeats the products of what the rates leave over; the driver sees sums of a fixed number."""
    size = len(r.on)

    def sums(batches):
        first, crossed = np.zeros(2 * size + 4), np.zeros((size, size) if repeats else 0)
        for b in batches:
            bits = np.frombuffer(b"".join(b.column("bits").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            votes, gold, n = np.unpackbits(bits, axis=1, count=size).astype(float), b.column("gold").to_numpy(), b.column("n").to_numpy().astype(float)
            post = r.posterior(votes, gold)
            known = n * (gold >= 0)
            first += np.concatenate([(n * post) @ votes, (n - n * post) @ votes, [(n * post).sum(), n.sum(), known.sum(), (known * np.where(gold == 1, post, 1 - post)).sum()]])
            if repeats:
                left = votes - np.outer(post, r.on) - np.outer(1 - post, r.off)
                crossed += (left * n[:, None]).T @ left
        yield pa.record_batch({"part": pa.array([np.concatenate([first, crossed.ravel()]).tolist()], pa.list_(pa.float64()))})

    def added(batches):
        every = 0
        for b in batches:
            for part in b.column("part"):
                every = every + part.values.to_numpy()
        if not np.isscalar(every):
            yield pa.record_batch({"part": pa.array([every.tolist()], pa.list_(pa.float64()))})

    # A row of sums for each task; FEW tasks add them up before the driver does.
    parts = patterns.mapInArrow(sums, "part array<double>").repartition(FEW).mapInArrow(added, "part array<double>")
    got = np.sum([np.array(r["part"]) for r in parts.collect()], axis=0)
    toxic, total, known, right = got[2 * size : 2 * size + 4]
    share = r.share
    if repeats:
        left = got[2 * size + 4 :].reshape(size, size) / total
        sd = np.sqrt(np.diag(left)) + 1e-9
        share = 1 / ((left / np.outer(sd, sd)) ** 2).sum(axis=1)
    on, off = (got[:size] + 0.5) / (toxic + 1), (got[size : 2 * size] + 0.5) / (total - toxic + 1)
    return Rates(float(np.clip(toxic / total, 1e-4, 1 - 1e-4)), on, off, share, float(np.clip(right / known, 0.6, TRUST)))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.2) -> tuple[np.ndarray, float]:
    """Newton steps for soft labels y."""
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, ridge = np.zeros(x1.shape[1]), np.append(np.full(x.shape[1], l2), 1e-3)
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w.astype(np.float32), -30, 30)))
        curve, weight = np.diag(ridge), (p * (1 - p)).astype(np.float32)
        for i in range(0, len(x1), 2000):  # in parts: the weighted rows are never all there at once
            part = x1[i : i + 2000]
            curve += (part * weight[i : i + 2000, None]).T @ part
        step = np.linalg.solve(curve, x1.T @ (y - p).astype(np.float32) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return w[:-1], float(w[-1])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labels outside the held-out fold only, and from all other texts outside it, without labels. Without both
    classes among the labels the seed lexicon decides alone."""
    model, fired = _fitted(docs, labels)
    if fired is not None:
        discard(fired)
    return model


def _fitted(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame | None]:
    """The model and how often each voter fires on each document: doc_id, at, times, words."""
    tuned(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, MAX_LABELLED / max(1, usable.count()))
    chosen = written(usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Of a doc_id that rows share the first text by digest counts.
    drawn = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text"), F.max("toxic").cast("int").alias("toxic"))
    sample = written(drawn.select("text", "toxic"))

    def mined(batches):
        seen, n = (Counter(), Counter()), [0, 0]
        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                n[y] += 1
                seen[y].update({f for w in set(_WORD.findall((text or "").lower())) for f in features_of(w)})
        names = [*(seen[0].keys() | seen[1].keys()), ""]
        yield pa.record_batch({"f": pa.array(names), "n1": pa.array([seen[1][f] for f in names[:-1]] + [n[1]], pa.int64()), "n0": pa.array([seen[0][f] for f in names[:-1]] + [n[0]], pa.int64())})

    found = sample.mapInArrow(mined, "f string, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    total = found.where("f = ''").first()
    if not total or not total["n1"] or not total["n0"]:
        voters = ["=" + w for w in SEED]
        return Model(voters, np.concatenate([np.full(len(SEED) + 2, 4.0), np.zeros(2 * (len(SEED) + 2))]), -2.0), None
    n1, n0 = total["n1"], total["n0"]
    lift = F.log((F.col("n1") + 0.5) / n1) - F.log((F.col("n0") + 0.5) / n0)
    top = found.where((F.col("n1") >= LEAST_DOCS) & (F.col("f") != "")).withColumn("lift", lift).where("lift > 1.5")
    ranked = top.orderBy((F.col("lift") * F.sqrt("n1")).desc(), "f").limit(4 * MAX_VOTERS).collect()
    voters, same = [], set()
    for r in ranked:  # of nested beginnings with the same counts one is enough
        key = (r["n1"], r["n0"], r["f"].lstrip("=")[:3])
        if key not in same and len(voters) < MAX_VOTERS:
            same.add(key)
            voters.append(r["f"])
    voters += [v for w in SEED if (v := "=" + w) not in voters]

    size = len(voters) + len(_PATTERNS)

    def counted(batches):
        memo = _Memo(voters)
        for b in batches:
            got = [_counts(t or "", memo, len(voters)) for t in b.column("text").to_pylist()]
            at = [np.flatnonzero(x) for x, _ in got]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "at": pa.array([k.tolist() for k in at], pa.list_(pa.int16())), "times": pa.array([x[k].astype(np.int32).tolist() for (x, _), k in zip(got, at)], pa.list_(pa.int32())), "words": pa.array([n for _, n in got], pa.int64())})

    fired = written(texts.mapInArrow(counted, "doc_id long, at array<short>, times array<int>, words long"))

    def packed(batches):
        for b in batches:
            seen = Counter()
            for at, gold in zip(b.column("at").to_pylist(), b.column("gold").to_pylist()):
                bits = np.zeros(size, np.uint8)
                bits[at] = 1
                seen[np.packbits(bits).tobytes(), gold] += 1
            yield pa.record_batch({"bits": pa.array([k for k, _ in seen], pa.binary()), "gold": pa.array([g for _, g in seen], pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    joined = fired.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).join(F.broadcast(chosen), "doc_id", "left")
    patterns = joined.select("at", F.coalesce("toxic", F.lit(-1)).cast("int").alias("gold")).mapInArrow(packed, "bits binary, gold int, n long").groupBy("bits", "gold").agg(F.sum("n").alias("n"))
    patterns = written(patterns)

    def of_sample(batches):
        memo = _Memo(voters)
        for b in batches:
            got = [_counts(t or "", memo, len(voters)) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"x": pa.array([x.tolist() for x, _ in got], pa.list_(pa.float32())), "n": pa.array([n for _, n in got], pa.int64()), "y": b.column("toxic")})

    rows = sample.mapInArrow(of_sample, "x array<float>, n long, y int").toPandas()
    x, n, gold = np.stack(rows["x"]), rows["n"].to_numpy(), rows["y"].to_numpy()
    del rows
    votes = (x > 0).astype(np.float32)
    rates = _first_rates(votes, gold)
    for k in range(ROUNDS):
        rates = _next_rates(patterns, rates, k % 4 == 1)
    discard(patterns, sample, chosen)
    # All texts shape the rates; the classifier learns from the posteriors of the labelled sample.
    weights, bias = _logistic(_rows(x, n), rates.posterior(votes, gold))
    return Model(voters, weights, bias), fired


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    A null or empty text scores as a text without votes; a document labelled twice counts as toxic if either says so;
    labels without a document, null labels and null ids are not learned from; equal rows get equal scores. Very long texts
    are read whole, and words of any length vote. Columns other than the id and the text are not looked
    at, whatever their names; an empty table gives no rows, and without usable labels the seed lexicon scores.
    """
    model, fired = _fitted(docs, labels)

    def run(batches):
        for b in batches:
            s = model.scores(b.column("text").to_pylist())
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))})

    def of_votes(batches):
        x = np.zeros(len(model.weights) // 3)
        for b in batches:
            lean = np.empty(b.num_rows)
            for i, (at, times, n) in enumerate(zip(b.column("at").to_pylist(), b.column("times").to_pylist(), b.column("words").to_pylist())):
                x[at] = times
                lean[i] = model.lean(x, n)
                x[at] = 0
            s = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))})

    shape = "doc_id long, score double, predicted int"
    got = fired.mapInArrow(of_votes, shape) if fired is not None else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, shape)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that score below one half."""
    tuned(docs.sparkSession)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.where(scores("text") < 0.5)
