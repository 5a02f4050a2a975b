"""Token counts of fields and sections by offsets.

The fields of a document are joined by line ends and encoded once, as one text. The byte lengths of the tokens give the
characters that each covers; sections (the lines of each field) are intervals of characters, and the two are joined. A
token that reaches over a boundary goes to the section that holds most of its characters, of equal shares to the earlier.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, tuned

_ENCODERS: dict = {}


class LengthEncoder:
    """Byte lengths of the tokens of a byte-level vocabulary. Each distinct pre-token is encoded once."""

    ODD = regex.compile(r"[\x00-\x08\x0e-\x1f\x85]|<\|")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.parts = regex.compile(public_tokenizers.PATTERN).findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}
        self.memo = Memo(self._lengths)

    @classmethod
    def of(cls, path: str) -> LengthEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _lengths(self, part: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(part.encode().decode("latin-1").translate(self.letters))
        return np.array([len(t.value) for t in tokens], "<u4").tobytes()

    def lengths(self, text: str) -> np.ndarray:
        if self.ODD.search(text):  # characters that regular expression engines see differently
            return np.array([len(t) for t in self.tokenizer.encode(text, add_special_tokens=False).tokens], "<u4")
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.parts(text))), "<u4")


def token_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character (exclusive) that each token touches."""
    stop = np.cumsum(lengths, dtype=np.int64)
    start = stop - lengths
    if not text.isascii():
        chars = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        start, stop = chars[start] - 1, chars[stop - 1]
    return start, stop


def attribute(start: np.ndarray, stop: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and those of them that cross a boundary, of each of the sections that begin at bounds and end at the next."""
    first = np.searchsorted(bounds, start, side="right") - 1
    last = np.searchsorted(bounds, stop - 1, side="right") - 1
    ends, owner = np.append(bounds[1:], np.iinfo(np.int64).max), first.copy()
    for k in np.flatnonzero(first != last):
        shares = [min(stop[k], ends[s]) - max(start[k], bounds[s]) for s in range(first[k], last[k] + 1)]
        owner[k] = first[k] + int(np.argmax(shares))
    return np.bincount(owner, minlength=len(bounds)), np.bincount(owner[first != last], minlength=len(bounds))


def count(docs: DataFrame, tokenizer_path: str, fields: tuple[str, ...] = ("source", "lang", "text")) -> DataFrame:
    """doc_id, field, section, start, stop, n_tokens, n_crossing: a row for each line of each field of each document.

    section counts from 0 within the field; start and stop are characters of the joined text, a line end belonging to
    the line before it. A null field counts as empty; an empty field that is not the last still has its line end; a
    section without characters gives no row, nor does a document without any. Equal rows give equal rows.
    """
    tuned(docs.sparkSession)
    names = ["doc_id", "field", "section", "start", "stop", "n_tokens", "n_crossing"]

    def run(batches):
        encoder = LengthEncoder.of(tokenizer_path)
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, *values in zip(b.column("doc_id").to_pylist(), *(b.column(f"f{k}").to_pylist() for k in range(len(fields)))):
                bounds, of, number, at = [], [], [], 0
                for k, v in enumerate(values):
                    lines = (v or "").split("\n")
                    for n, line in enumerate(lines):
                        size = len(line) + (n + 1 < len(lines) or k + 1 < len(values))
                        if size:
                            bounds.append(at)
                            of.append(fields[k])
                            number.append(n)
                        at += size
                if not bounds:
                    continue
                text, starts = "\n".join(v or "" for v in values), np.array(bounds)
                n, crossing = attribute(*token_spans(text, encoder.lengths(text)), starts)
                for o, x in zip(out, ([doc_id] * len(of), of, number, bounds, [*bounds[1:], at], n.tolist(), crossing.tolist())):
                    o += x
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(o, t) for o, t in zip(out, types)], names=names)

    columns = [F.col(c).cast("string").alias(f"f{k}") for k, c in enumerate(fields)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns).mapInArrow(run, "doc_id long, field string, section int, start long, stop long, n_tokens long, n_crossing long")
