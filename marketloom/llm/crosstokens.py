"""Alignment of two tokenizers and counts of the pairs of ids that it links.

A text is encoded by both tokenizers once, and the ids are kept in a table. Byte offsets where tokens of both end cut the
ids into groups; all texts of a batch are aligned at once. The distinct pairs of ids get a minimal perfect hash, which
gives each a place in a dense vector of counts; a pass over the ids counts documents, task by task, and the vectors are
summed as a tree; a second pass aligns the documents again and looks counts up, each under the key stored at its place.
Pairs are bounded by the two vocabularies; where they are more than SLICE, the passes that count and look up take slices
of the first tokenizer's ids one after the other.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, tuned, written

#: Pairs whose hash, keys and counts a worker holds at once (some 14 bytes each); places in a piece of a count vector;
#: tokens that are aligned at once, where a text alone has not more; links of a group that are listed one by one.
SLICE, PIECE, TOKENS, LISTED = 8_000_000, 8192, 400_000, 4096
#: What follows an id in the text of the groups.
SIGNS = (",", "|", ";", "")


class Encoders:
    """Both vocabularies: ids of texts, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        byte_of = {**{chr(x): x for x in shown}, **{chr(256 + k): x for k, x in enumerate(hidden)}}
        merged = [(m if isinstance(m, str) else " ".join(m)).replace(" ", "") for m in model["merges"]]
        if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("ids of the first vocabulary don't follow its merges")
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(merged)}
        self.a = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = lib = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        bytes_b = [bytes([int(n[3:5], 16)]) if lib.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            bytes_a[i] = t
        if max(len(bytes_a), len(bytes_b)) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (bytes_a, bytes_b))
        self.decimal = [f"{i}{sign}" for i in range(max(len(bytes_a), len(bytes_b))) for sign in SIGNS]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each text as 16-bit integers; none where either tokenizer doesn't give the bytes back."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a, raw = self.a.encode_ordinary(" " + text) if text else [], (" " + text).encode()
            whole = text and b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
            out.append((np.array(a, "<u2").tobytes(), np.array(b, "<u2").tobytes()) if whole else (b"", b""))
        return out


_ENCODERS: dict = {}


def encoders(path_a: str, path_b: str) -> Encoders:
    if (path_a, path_b) not in _ENCODERS:
        _ENCODERS[path_a, path_b] = Encoders(path_a, path_b)
    return _ENCODERS[path_a, path_b]


class Aligned:
    """The groups of some texts, given the ids of each."""

    def __init__(self, with_: Encoders, ids: list[tuple[bytes, bytes]]):
        self.with_ = with_
        self.a, self.b = (np.frombuffer(b"".join([x[k] for x in ids]), "<u2").astype(np.int64) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(x[k]) // 2 for x in ids], np.int64) for k in (0, 1))
        end_a, end_b = np.cumsum(with_.length_a[self.a]), np.cumsum(with_.length_b[self.b])
        ends = np.zeros(int(end_a[-1] if len(end_a) else 0) + 1, np.int8)
        ends[end_a] = 1
        self.last_b = ends[end_b] == 1
        ends[end_a] = 0
        ends[end_b] = 1
        self.last_a = ends[end_a] == 1
        # Group of each token, first token of each group (one more at the end), text of each group.
        self.group_a, self.group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        self.first_a, self.first_b = (np.concatenate([[0], np.flatnonzero(last) + 1]) for last in (self.last_a, self.last_b))
        self.text_of = np.repeat(np.arange(len(ids)), self.n_a)[self.first_a[:-1]]
        self.n_groups = np.bincount(self.text_of, minlength=len(ids))
        self.size_a, self.size_b = np.diff(self.first_a), np.diff(self.first_b)
        self.n_links = self.per_text(self.text_of, self.size_a * self.size_b)

    def per_text(self, text: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n_a), np.int64)
        np.add.at(out, text, values)
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (a << 16 | b) and number of each link; a large group has its distinct pairs once each."""
        small = self.size_a * self.size_b <= LISTED
        of_a = np.flatnonzero(small[self.group_a])
        many = self.size_b[self.group_a[of_a]]
        left = np.repeat(of_a, many)
        right = np.arange(len(left)) + np.repeat(self.first_b[self.group_a[of_a]] - (np.cumsum(many) - many), many)
        text, pair = self.text_of[self.group_a[left]], self.a[left] << 16 | self.b[right]
        parts = [(text, pair, np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(~small).tolist():
            x, n_x = np.unique(self.a[self.first_a[g] : self.first_a[g + 1]], return_counts=True)
            y, n_y = np.unique(self.b[self.first_b[g] : self.first_b[g + 1]], return_counts=True)
            pair = (x[:, None] << 16 | y).ravel()
            parts.append((np.full(len(pair), self.text_of[g]), pair, (n_x[:, None] * n_y).ravel()))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def shown(self) -> list[str]:
        """The groups of each text: a,a|b;a|b,b."""
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + self.first_b[self.group_a]] = self.a * 4 + self.last_a
        code[np.arange(len(self.b)) + self.first_a[self.group_b + 1]] = self.b * 4 + 2 * self.last_b
        ends = np.cumsum(self.n_a + self.n_b)
        code[ends[self.n_a > 0] - 1] += 1
        text = list(map(self.with_.decimal.__getitem__, code.tolist()))
        return ["".join(text[e - n : e]) for e, n in zip(ends.tolist(), (self.n_a + self.n_b).tolist())]


def aligned(batches, path_a: str, path_b: str):
    """Aligned texts of batches of ids, at most about TOKENS at once, with their doc_ids."""
    with_ = encoders(path_a, path_b)
    for b in batches:
        ids = list(zip(b.column("a").to_pylist(), b.column("b").to_pylist()))
        doc_ids, part, n = b.column("doc_id").to_pylist(), [], 0
        for k, x in enumerate(ids):
            part.append(k)
            n += len(x[0]) // 2
            if n > TOKENS or k + 1 == len(ids):
                yield [doc_ids[i] for i in part], Aligned(with_, [ids[i] for i in part])
                part, n = [], 0


# --- minimal perfect hashing -----------------------------------------------------------------------------------------------


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Each of n distinct keys has a place of its own below n. In a level of twice as many bits as it has keys, keys that
    meet no other keep the bit; the others go to the next level. A key's place is the number of set bits before its own."""

    def __init__(self, keys: np.ndarray):
        self.levels, before, rest = [], 0, keys
        while len(rest):
            size = 64 * (len(rest) // 32 + 1)
            at = (_mixed(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little")
            ranks = before + np.concatenate([[0], np.cumsum(np.bitwise_count(bits.view(np.uint64)), dtype=np.int64)])
            self.levels.append((size, bits, ranks))
            before, rest = int(ranks[-1]), rest[~alone[at]]
        self.n = before
        self.keys = np.zeros(self.n, keys.dtype)
        self.keys[self._places(keys)] = keys

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Places; of a key that is none of the n any place, or -1."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (size, bits, ranks) in enumerate(self.levels):
            at = (_mixed(keys[open_], k) % np.uint64(size)).astype(np.int64)
            word = bits.view(np.uint64)[at >> 6]
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            here = (word & bit) != 0
            out[open_[here]] = ranks[at[here] >> 6] + np.bitwise_count(word[here] & (bit[here] - np.uint64(1)))
            open_ = open_[~here]
            if not len(open_):
                break
        return out

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, verified against the key stored there; -1 for all others."""
        out = self._places(keys)
        found = out >= 0
        found[found] = self.keys[out[found]] == keys[found]
        return np.where(found, out, -1)


# --- passes ----------------------------------------------------------------------------------------------------------------


def encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, a, b: the ids of each row's text."""

    def run(batches):
        with_ = encoders(path_a, path_b)
        for b in batches:
            ids = with_.encode([x or "" for x in b.column("text").to_pylist()])
            yield pa.record_batch([b.column("doc_id"), *(pa.array([x[k] for x in ids], pa.binary()) for k in (0, 1))], names=["doc_id", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, a binary, b binary")


def distinct_pairs(ids: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """pair (a << 16 | b): each linked pair of ids once. Tasks send their own pairs, each once for every few million links."""

    def run(batches):
        found, n = [], 0
        for _, x in aligned(batches, path_a, path_b):
            found.append(np.unique(x.links()[1]))
            n += len(found[-1])
            if n > 2 * SLICE or len(found) >= 32:
                found = [np.unique(np.concatenate(found))]
                n = len(found[0])
            if n > SLICE:
                yield pa.record_batch([pa.array(found.pop())], names=["pair"])
                n = 0
        yield pa.record_batch([pa.array(np.unique(np.concatenate(found)) if found else np.empty(0, np.int64))], names=["pair"])

    return ids.mapInArrow(run, "pair long").distinct()


def document_counts(ids: DataFrame, table, path_a: str, path_b: str, fan: int = 16) -> np.ndarray:
    """How many documents hold each pair of the table (a broadcast PerfectHash) linked, by place."""

    def run(batches):
        from pyspark import TaskContext

        counts = np.zeros(table.value.n, np.int64)
        for _, x in aligned(batches, path_a, path_b):
            text, pair, _ = x.links()
            once = np.unique(text << 32 | pair) & 0xFFFFFFFF
            at = table.value.places(once)
            np.add.at(counts, at[at >= 0], 1)
        pieces = [k for k in range(0, len(counts), PIECE) if counts[k : k + PIECE].any()]
        task = TaskContext.get().partitionId()
        columns = ([k // PIECE for k in pieces], [task] * len(pieces), [zlib.compress(counts[k : k + PIECE].tobytes(), 1) for k in pieces])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], names=["piece", "task", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in group.column("counts").to_pylist())
        task = group.column("task")[0].as_py() // fan
        return pa.table({"piece": group.column("piece")[:1], "task": pa.array([task], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    shape = "piece int, task int, counts binary"
    sums, tasks = ids.mapInArrow(run, shape), ids.rdd.getNumPartitions()
    while True:  # a tree: fan vectors meet in one, until one is left
        sums = sums.groupBy("piece", F.expr(f"task div {fan}")).applyInArrow(add, shape)
        if (tasks := -(-tasks // fan)) <= 1:
            break
    out = np.zeros(table.value.n, np.int64)
    for r in sums.collect():  # as long as the table
        part = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
        out[r["piece"] * PIECE : r["piece"] * PIECE + len(part)] += part
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SHAPE = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in NAMES)


def looked_up(ids: DataFrame, table, counts, path_a: str, path_b: str) -> DataFrame:
    """A row for each document; n_best and count_sum over the pairs that the table has. counts: broadcast (count of each
    place, whether it is the highest of its first id)."""

    def run(batches):
        count, best = counts.value
        for doc_ids, x in aligned(batches, path_a, path_b):
            text, pair, times = x.links()
            at = table.value.places(pair)
            here = at >= 0
            text, times, at = text[here], times[here], at[here]
            sums = [x.per_text(text, times * best[at]), x.per_text(text, times * count[at])]
            sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.shown()]
            columns = [doc_ids, x.n_a, x.n_b, x.n_groups, x.n_links, *sums]
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns), pa.array(sha, pa.string())], names=NAMES)

    return ids.mapInArrow(run, SHAPE)


def align(docs: DataFrame, path_a: str, path_b: str, most: int = SLICE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: a row for each row of docs.

    path_a: a byte-level vocabulary of the tokenizers library, given a space and the text; path_b: a merge-type model of
    the sentencepiece library, given the text. A document whose text is null, empty, or not given back byte by byte by
    either has zeros and an empty hash, and counts nowhere. Special tokens in a text are plain text. Of counts that tie
    for the highest of an id all are best. A row counts as a document, equal rows each. A text is worked on whole, however
    long; a long run without a common boundary is one group, whose distinct pairs are counted. An empty table gives no
    rows. Other columns are not looked at, whatever their names.
    """
    spark = tuned(docs.sparkSession)
    ids = written(encoded(docs, path_a, path_b))
    pairs = written(distinct_pairs(ids, path_a, path_b))
    slices = max(1, -(-pairs.count() // most))
    outs = []
    for k in range(slices):
        own = pairs.where(F.pmod(F.hash(F.shiftright("pair", 16)), F.lit(slices)) == k)
        keys = own.toArrow().column("pair").to_numpy()  # about `most`: all pairs of some first ids
        table = spark.sparkContext.broadcast(PerfectHash(np.sort(keys).astype(np.uint32)))
        count = document_counts(ids, table, path_a, path_b)
        first = table.value.keys >> 16
        highest = np.zeros(1 << 16, np.int64)
        np.maximum.at(highest, first, count)
        outs.append(looked_up(ids, table, spark.sparkContext.broadcast((count, count == highest[first])), path_a, path_b))
    discard(pairs)
    if slices == 1:
        return outs[0]
    # Rows that are equal in the other columns are equal in the sums as well.
    parts = [written(o) for o in outs]
    whole = parts[0]
    for o in parts[1:]:
        whole = whole.unionByName(o)
    sums = ("n_best", "count_sum")
    whole = whole.groupBy(*[c for c in NAMES if c not in sums]).agg((F.count("*") / slices).cast("long").alias("rows"), *[F.sum(c).alias(c) for c in sums])
    per_row = [F.expr(f"{c} div rows").alias(c) if c in sums else F.col(c) for c in NAMES]
    return whole.select(*per_row, F.explode(F.sequence(F.lit(1), "rows")).alias("copy")).drop("copy")
