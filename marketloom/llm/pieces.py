"""SentencePiece encoding and decoding for merge-type vocabularies.

Symbols start as single characters. An agenda holds each adjacent pair whose join is in the vocabulary; the pair with the
best score goes first, of equal scores the leftmost. A text falls into chunks across which no piece of the vocabulary
reaches, and each distinct chunk is encoded once: short ones many at a time, as rows of a matrix whose best pair is taken
in every row at each step; long ones with a heap. Every Arrow batch is checked against the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tuned

SPACE = "▁"
#: Chunks that a worker remembers; longest chunk, in characters, that is encoded as a matrix row, and that is remembered.
MEMO_CHUNKS, ROW, LONGEST = 500_000, 48, 1024

_CODECS: dict = {}


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        assert n < 1 << 16
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        self.symbol = {names[i]: i for i in plain}
        self.text_of = [b""] * n
        for i in plain:
            self.text_of[i] = names[i].replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            self.text_of[i] = bytes([b])
        self.text_of[self.unknown] = " ⁇ ".encode()
        self.length = np.array([len(t) for t in self.text_of])
        self.place, self.texts = np.cumsum(self.length) - self.length, np.frombuffer(b"".join(self.text_of), np.uint8)
        inner = {c for i in plain if len(names[i]) > 1 for c in names[i]}
        assert not any(SPACE in names[i].lstrip(SPACE) for i in plain), "a piece reaches across words"
        for c in sorted(inner - self.symbol.keys()):  # characters that only occur within pieces
            self.symbol[c] = len(self.symbol) + n
        self.first_extra = n
        self.score = np.full(n + 1, -np.inf)
        for i in plain:
            self.score[i] = lib.get_score(i)
        joins = {}
        for i in plain:
            for k in range(1, len(names[i])):
                a, b = self.symbol.get(names[i][:k]), self.symbol.get(names[i][k:])
                if a is not None and b is not None:
                    joins[a << 20 | b] = i
        self.joins = joins
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.keys.tolist()], np.int32)
        ends = "" if "\n" in inner else "\n"  # a character that no longer piece has is a chunk of its own
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+" + (f"|[{ends}]" if ends else "")).findall
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in _CODECS:
            _CODECS[path] = cls(path)
        return _CODECS[path]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the join of each pair, -1 if there is none."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.joined[at], -1)

    def _rows(self, chunks: list[str], width: int) -> np.ndarray:
        """Chunks of at most width characters, all at once. Symbols that are in no piece are -2 and never join."""
        symbols = np.full((len(chunks), width), -1, np.int32)
        flat = [self.symbol.get(c, -2) for c in "".join(chunks)]
        lengths = np.array([len(c) for c in chunks])
        symbols[np.arange(width) < lengths[:, None]] = flat
        pairs = self._pairs(symbols[:, :-1], symbols[:, 1:]).astype(np.int32)
        done = np.full((len(chunks), width), -1, np.int32)
        rows = np.arange(len(chunks))
        while len(rows):
            score = self.score[pairs]
            best = score.argmax(axis=1)
            live = score[np.arange(len(rows)), best] > -np.inf
            done[rows[~live]] = symbols[~live]
            rows, symbols, pairs, best = rows[live], symbols[live], pairs[live], best[live]
            if not len(rows):
                break
            k = np.arange(len(rows))
            symbols[k, best] = pairs[k, best]
            take = np.arange(width - 1) + (np.arange(width - 1) > best[:, None])
            symbols = np.concatenate([np.take_along_axis(symbols, take, axis=1), np.full((len(rows), 1), -1, np.int32)], axis=1)
            take = np.minimum(np.arange(width - 1) + (np.arange(width - 1) >= best[:, None]), width - 2)
            pairs = np.take_along_axis(pairs, take, axis=1)
            pairs[:, -1] = -1
            right = np.minimum(best + 1, width - 1)
            new = self._pairs(symbols[k, best], symbols[k, right])
            at = best < width - 1
            pairs[k[at], best[at]] = new[at]
            left = best > 0
            pairs[k[left], best[left] - 1] = self._pairs(symbols[k, np.maximum(best - 1, 0)], symbols[k, best])[left]
        return done

    def _heap(self, chunk: str) -> list[int]:
        """A chunk of any length, in n log n steps."""
        s = [self.symbol.get(c, -2) for c in chunk]
        before, after = list(range(-1, len(s) - 1)), [*range(1, len(s)), -1]
        agenda: list[tuple] = []

        def propose(a, b):
            if a >= 0 and b >= 0 and (i := self.joins.get(s[a] << 20 | s[b]) if s[a] >= 0 and s[b] >= 0 else None) is not None:
                heapq.heappush(agenda, (-self.score[i], a, b, s[a], s[b], i))

        for a in range(len(s) - 1):
            propose(a, a + 1)
        while agenda:
            _, a, b, x, y, i = heapq.heappop(agenda)
            if s[a] != x or s[b] != y or after[a] != b:
                continue
            s[a], s[b] = i, -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            propose(before[a], a)
            propose(a, after[a])
        return s

    def _spelled(self, chunk: str, symbols: list[int]) -> bytes:
        """Ids of a chunk's symbols; those outside the vocabulary are spelled in bytes."""
        if -2 not in symbols and max(symbols, default=0) < self.first_extra:
            return np.array([x for x in symbols if x >= 0], "<u2").tobytes()
        out, at, extra = [], 0, {i: c for c, i in self.symbol.items() if i >= self.first_extra}
        for x in symbols:
            if x == -1:
                continue
            if 0 <= x < self.first_extra:
                out.append(x)
                at += len(self.library.id_to_piece(x))
            else:
                c = extra.get(x, chunk[at])
                out += [self.byte_id.get(b, self.unknown) for b in c.encode()] if self.byte_id else [self.unknown]
                at += 1
        return np.array(out, "<u2").tobytes()

    def learn(self, chunks: list[str]) -> None:
        by_width: dict[int, list[str]] = {}
        for c in chunks:
            by_width.setdefault(next((w for w in (6, 9, 12, 16, 24, ROW) if len(c) <= w), 0), []).append(c)
        for c in by_width.pop(0, ()):
            self.memo[c] = self._spelled(c, self._heap(c))
        for width, some in by_width.items():
            for i in range(0, len(some), 20_000):
                part = some[i : i + 20_000]
                done = self._rows(part, width)
                odd = ((done == -2) | (done >= self.first_extra)).any(axis=1)
                ids, ends = done[done >= 0].astype("<u2").tobytes(), np.append(0, np.cumsum((done >= 0).sum(axis=1)) * 2).tolist()
                self.memo.update((c, ids[s:e]) for c, s, e in zip(part, ends, ends[1:]))
                self.memo.update((part[k], self._spelled(part[k], done[k].tolist())) for k in np.flatnonzero(odd).tolist())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with begin and end."""
        if len(self.memo) > MEMO_CHUNKS:  # two generations: what is still in use moves on to the next
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        split = [self.chunks(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = {c for chunks in split for c in chunks if c not in memo}
        memo.update((c, older[c]) for c in new if c in older)
        self.learn([c for c in new if c not in memo])
        bos, eos = (np.array([i], "<u2").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        out = [np.frombuffer(b"".join([bos, *map(memo.__getitem__, chunks), eos]), "<u2") for chunks in split]
        for c in new:
            if len(c) > LONGEST:
                del memo[c]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that encoding puts first is taken off."""
        length = self.length[ids]
        shift = self.place[ids] - (np.cumsum(length) - length)
        data = self.texts[np.arange(length.sum()) + np.repeat(shift, length)].tobytes()
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (binary, 32-bit little-endian), decoded: a row for each row.

    A null text counts as empty (begin and end only). With check, a batch that differs from the sentencepiece library in
    any id or any decoded character raises an error. Equal rows give equal results; an empty table gives no rows. A very
    long text is encoded whole; a long run without a space is one chunk, encoded through a heap and not remembered. Other
    columns are not looked at, whatever their names.
    """
    tuned(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]

    def run(batches):
        codec = Codec.of(model_path)
        for b in batches:
            texts = [x or "" for x in b.column("text").to_pylist()]
            ids = codec.encode(texts)
            decoded = [codec.decode(x) for x in ids]
            if check:
                theirs = codec.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
                if any(a.tolist() != t for a, t in zip(ids, theirs)):
                    raise ValueError("ids differ from the sentencepiece library's")
                if codec.library.decode(theirs) != decoded:
                    raise ValueError("text differs from the sentencepiece library's")
            raw = [x.astype("<u4").tobytes() for x in ids]
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.record_batch(
                [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(map(sha, raw), pa.string()), pa.array([sha(x.encode()) for x in decoded], pa.string()), pa.array(raw, pa.binary()), pa.array(decoded, pa.string())],
                names=names,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded string")
