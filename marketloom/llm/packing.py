"""Packing of token sequences by non-negative least squares.

A document's tokens are cut into whole windows, a middle piece of a multiple of UNIT tokens and a rest below UNIT. For the
histogram of middle pieces, all shallow combinations that fill a window are enumerated, their repeat counts are solved by
non-negative least squares and rounded down; what is left over, and the rests, are packed greedily end to end, cut where
a window is full. The last window of a block is split into sequences of powers of two, which are not padded.

Blocks of documents are packed apart, each within the task that encoded it: nothing is shuffled, a block holds a bounded
number of tokens, and a task run again on another executor gives the same sequences.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, Memo, blobs, give_back, tuned

WINDOW, UNIT, DEPTH, END_ID = 2048, 64, 4, 1
#: Tokens of a block, about.
BLOCK_TOKENS = 4_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_ENCODERS: dict = {}


class WordEncoder:
    """Ids of whole texts for the lower-casing word tokenizer, whose tokens never cross white space.

    Each distinct word is encoded once, and of common words only the merges are run: the library's model gets the parts
    that its own rules (lower case, then runs of letters, single digits, runs of other signs) give. Words with anything
    beyond PLAIN go through the whole library.
    """

    PLAIN = regex.compile(r"[!-~\u00a1-\u00ac\u00ae-\u024f\u2013-\u2026]+")
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    SIGNS = b".,;:!?)"

    def __init__(self, path: str, memory: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        assert self.tokenizer.get_vocab_size() <= 1 << 16
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}
        self.words, self.parts = Memo(self._word, 2 * memory), Memo(self._part, memory)

    @classmethod
    def of(cls, path: str, memory: int = MEMO_WORDS) -> WordEncoder:
        if (path, memory) not in _ENCODERS:
            _ENCODERS[path, memory] = cls(path, memory)
        return _ENCODERS[path, memory]

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array("H", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters are one part, with a sign after them two
            return self.parts[word.lower().decode()]
        if word[:-1].isalpha() and word[-1:] in self.SIGNS:
            return self.parts[word[:-1].lower().decode()] + self.parts[chr(word[-1])]
        text = word.decode("utf-8", "replace")
        if "<|" in text or not self.PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        return b"".join(map(self.parts.__getitem__, self.PARTS.findall(text.lower())))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Arrays of 16-bit ids. Words are parted at the six ASCII white-space characters."""
        return [np.frombuffer(b"".join(map(self.words.__getitem__, t.split())), "<u2") for t in texts]


@lru_cache
def combinations(total: int = WINDOW // UNIT, depth: int = DEPTH) -> np.ndarray:
    """Rows of counts by length (in units, below total) of every combination of 2 to depth pieces that fills a window."""

    def parts(left, most, n):
        if left == 0:
            yield []
        elif n:
            for first in range(min(left, most), 0, -1):
                for rest in parts(left - first, first, n - 1):
                    yield [first, *rest]

    return np.array([np.bincount(p, minlength=total) for p in parts(total, total - 1, depth)])


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        free[best] = True
        while True:
            y = np.zeros_like(x)
            y[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (y <= 1e-12)
            if not low.any():
                x = y
                break
            step = (x[low] / np.maximum(x[low] - y[low], 1e-300)).min()
            x = x + step * (y - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


def plan(histogram: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Combinations with repeat counts that use no more pieces of a length than there are."""
    combos, left = combinations(), histogram.astype(np.int64).copy()
    x, out = nnls(combos.T.astype(float), histogram.astype(float)), []
    for k in [*np.argsort(-x, kind="stable"), *range(len(combos))]:  # the solution first, then whatever still fits
        used = combos[k] > 0
        n = int((left[used] // combos[k][used]).min())
        n = min(n, int(x[k])) if len(out) < len(combos) else n
        out.append((combos[k], n))
        left -= n * combos[k]
    return [(c, n) for c, n in out if n]


def pack_block(docs: list[tuple], first_id: int) -> tuple[list[tuple], int]:
    """Pieces of docs (doc_id, ids); sequence ids from first_id on. Returns rows of SCHEMA and the next free id."""
    rows, sequence, rest = [], first_id, []
    middle: list[list] = [[] for _ in range(WINDOW // UNIT)]

    def put(doc, start, length, sequence, offset):
        doc_id, ids = docs[doc]
        rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length].astype("<u4").tobytes()), len(ids), sequence, offset))

    for doc, (_, ids) in enumerate(docs):
        whole, left = divmod(len(ids), WINDOW)
        for k in range(whole):
            put(doc, k * WINDOW, WINDOW, sequence, 0)
            sequence += 1
        if units := left // UNIT:
            middle[units].append((doc, whole * WINDOW))
        if left % UNIT:
            rest.append((doc, whole * WINDOW + units * UNIT, left % UNIT))
    for combo, n in plan(np.array([len(m) for m in middle])):
        lengths = np.repeat(np.arange(len(combo)), combo)
        for _ in range(n):
            offset = 0
            for units in lengths:
                put(*middle[units].pop(), int(units) * UNIT, sequence, offset)
                offset += int(units) * UNIT
            sequence += 1
    stream = [(doc, start, units * UNIT) for units, m in enumerate(middle) for doc, start in m] + rest
    left = sum(x[2] for x in stream)
    sizes = [WINDOW] * (left // WINDOW) + [1 << k for k in range(WINDOW.bit_length(), -1, -1) if left % WINDOW >> k & 1]
    sizes, offset = iter(sizes), 0
    room = next(sizes, 0)
    for doc, start, length in stream:
        while length:
            n = min(length, room - offset)
            put(doc, start, n, sequence, offset)
            start, length, offset = start + n, length - n, offset + n
            if offset == room:
                sequence, offset, room = sequence + 1, 0, next(sizes, 0)
    return rows, sequence


def pack(docs: DataFrame, tokenizer_path: str, memory: int = MEMO_WORDS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document ends with END_ID, so that a null or empty text is one piece of one token. Equal rows are packed as
    documents of their own; a null doc_id is kept as null; an empty table gives no rows. A very long text is encoded as
    one array of its ids and cut into windows like any other. Columns other than doc_id and text are not looked at,
    whatever their names. memory: words that a worker remembers, twice over; it bounds memory and changes no result.
    """
    tuned(docs.sparkSession)

    def run(batches):
        encoder = WordEncoder.of(tokenizer_path, memory)
        block, tokens, sequence = [], 0, TaskContext.get().partitionId() << 40

        def flushed():
            nonlocal block, tokens, sequence
            rows, sequence = pack_block(block, sequence)
            block, tokens = [], 0
            for i in range(0, len(rows), 20_000):
                cols = zip(*rows[i : i + 20_000])
                yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for b in batches:
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(blobs(b.column("text")))):
                block.append((doc_id, np.append(ids, np.uint16(END_ID))))
                tokens += len(ids) + 1
                if tokens >= BLOCK_TOKENS:
                    yield from flushed()
        if block:
            yield from flushed()
        encoder.words.older, encoder.parts.older = {}, {}  # a worker waits for its next task with the younger words only
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
