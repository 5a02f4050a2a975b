"""Product codes of vectors by exact integer k-means.

Components become integers. Products are taken by BLAS on limbs: integers are broken into limbs so short that no sum of
their products leaves the integers that a double holds, and the limbs' products meet again in 64-bit integers. The first
of the least distances decides. A round of the codebooks is one pass over the vectors: tasks send a sum for each entry
and component, in limbs as well, so that sums of any size are exact; the driver sees the codebooks only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, tuned, written

#: Bits of the limbs in which sums travel.
SUM_BITS = 32
LONG = (1 << 63) - 1


def _largest(a: np.ndarray) -> int:
    return max((abs(int(a.min())), abs(int(a.max()))), default=0) if a.size else 0


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """a = sum of limb k << bits * k, as doubles; all limbs but the last are in [0, 2**bits), the last carries the sign."""
    out, rest = [], a
    while _largest(rest) >= 1 << bits:
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integers, exact: int64 where the result fits, else Python integers."""
    inner = max(1, a.shape[1])
    if inner * _largest(a) * _largest(b) >= 1 << 62:
        return a.astype(object) @ b.astype(object)
    bits = (52 - (inner - 1).bit_length()) // 2  # inner * 2**bits * 2**bits stays below 2**53
    out = np.zeros((a.shape[0], b.shape[1]), np.int64)
    left, right = limbs(a, bits), limbs(b, bits)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            out += (x @ y).astype(np.int64) << (bits * (i + j))
    return out


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64, or Python integers where a value is beyond 2**60."""
    y = x.astype(np.float64)
    if np.abs(y).max(initial=0) < 2.0**60 / scale:
        return np.floor(scale * y).astype(np.int64)
    return np.array([scale * int(v) if abs(v) >= 2.0**60 else int(np.floor(scale * v)) for v in y.ravel().tolist()], object).reshape(y.shape)


def bounds(d: int, parts: int) -> list[int]:
    """Where parts begin and end; of lengths that parts does not divide the first parts are one longer."""
    return np.cumsum([0, *[d // parts + (p < d % parts) for p in range(parts)]]).tolist()


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first entry at the least squared distance of each row, and that distance."""
    dot = exact_product(x, book.T)
    wide = dot.dtype == object or (_largest(x) + _largest(book)) ** 2 * max(1, x.shape[1]) >= 1 << 62
    kind = object if wide else np.int64
    x, book, dot = x.astype(kind), book.astype(kind), dot.astype(kind)
    distance = (book * book).sum(axis=1)[None, :] - 2 * dot + (x * x).sum(axis=1)[:, None]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(x)), best]


def _matrix(column, d: int, scale: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d), scale)


def _by_length(batch):
    """Rows of a batch by the length of their vectors."""
    d = batch.column("d").to_numpy()
    for n in np.unique(d).tolist():
        rows = np.flatnonzero(d == n)
        yield n, rows, batch.column("x").take(pa.array(rows))


def _sums(rows: DataFrame, books: dict[int, list[np.ndarray]], scale: int, parts: int) -> DataFrame:
    """A task's sums: d, part, entry, place (-1: the count), limb, value."""

    def run(batches):
        total: dict = {}
        for b in batches:
            for d, _, x in _by_length(b):
                x, at = _matrix(x, d, scale), bounds(d, parts)
                for p, book in enumerate(books[d]):
                    part = x[:, at[p] : at[p + 1]]
                    best, _ = nearest(part, book)
                    chosen = (np.arange(len(book))[:, None] == best).astype(np.int64)
                    sums = np.concatenate([exact_product(chosen, part).astype(object), chosen.sum(axis=1)[:, None].astype(object)], axis=1)
                    total[d, p] = total[d, p] + sums if (d, p) in total else sums
        out = []
        for (d, p), sums in total.items():
            for e, row in enumerate(sums.tolist()):
                if row[-1]:
                    for place, v in enumerate(row):
                        sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
                        while v or not limb:
                            out.append((d, p, e, place if place + 1 < len(row) else -1, limb, sign * (v & ((1 << SUM_BITS) - 1))))
                            v, limb = v >> SUM_BITS, limb + 1
        columns = list(zip(*out)) if out else [[]] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 5 + [pa.int64()])], names=["d", "part", "entry", "place", "limb", "value"])

    found = rows.select("d", "x").mapInArrow(run, "d int, part int, entry int, place int, limb int, value long")
    return found.groupBy("d", "part", "entry", "place", "limb").agg(F.sum("value").alias("value"))


def codebooks(rows: DataFrame, scale: int, parts: int, entries: int, rounds: int) -> dict[int, list[np.ndarray]]:
    """Codebooks of the vectors x of each length d: a matrix for each part, a row for each entry."""
    books = {}
    for (d,) in rows.select("d").distinct().collect():  # lengths, a few at most
        first = rows.where(F.col("d") == d).orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
        start = integers(np.array([r["x"] for r in first], np.float64).reshape(len(first), d), scale)
        at = bounds(d, parts)
        books[d] = [start[:, at[p] : at[p + 1]] for p in range(parts)]
    for _ in range(rounds):
        got: dict = {}
        for r in _sums(rows, books, scale, parts).collect():  # as many rows as the codebooks have components
            key = (r["d"], r["part"], r["entry"])
            places = got.setdefault(key, {})
            places[r["place"]] = places.get(r["place"], 0) + (r["value"] << (SUM_BITS * r["limb"]))
        for (d, p, e), places in got.items():
            book = books[d][p].astype(object)
            book[e] = [places[k] // places[-1] for k in range(book.shape[1])]
            books[d][p] = book.astype(np.int64) if _largest(book) < 1 << 60 else book
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for row in book.tolist() for v in row).encode()).hexdigest()


def compress(vectors: DataFrame, scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each row of vectors (vec_id, embedding, label).

    Vectors that are null or empty, or hold null or non-finite components, take no part. Codebooks start as the parts of
    the vectors of the smallest ids (null ids last, of equal ids the smaller vector first); fewer vectors give fewer
    entries. Ties go to the lower index; an entry without parts stays. Vectors of another length have codebooks of their
    own; parts are as equal as the length allows. Equal rows give equal rows, each counted. Errors are summed over equal
    labels, null labels together; components may be of any size, and an error beyond a long is cut to its range. Empty
    tables give no rows. Other columns are not looked at, whatever their names.
    """
    tuned(vectors.sparkSession)
    assert 1 <= entries <= 256 and parts >= 1
    fine = vectors.select("vec_id", F.col("embedding").alias("x"), "label").where(
        "size(x) > 0 and forall(x, v -> v is not null and not isnan(v) and abs(cast(v as double)) < double('infinity'))"
    )
    rows = written(fine.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("x").alias("d"), "x", "label"))
    books = codebooks(rows, scale, parts, entries, rounds)
    digests = {d: digest(b) for d, b in books.items()}

    def run(batches):
        for b in batches:
            codes, errors, sha = [""] * b.num_rows, [0] * b.num_rows, [""] * b.num_rows
            for d, places, x in _by_length(b):
                x, at = _matrix(x, d, scale), bounds(d, parts)
                found = [nearest(x[:, at[p] : at[p + 1]], book) for p, book in enumerate(books[d])]
                code = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
                error = sum(e.astype(object) for _, e in found)
                for place, c, e in zip(places.tolist(), code, error.tolist()):
                    codes[place], errors[place], sha[place] = c.tobytes().hex(), min(int(e), LONG), digests[d]
            yield pa.record_batch(
                [b.column("vec_id"), pa.array(codes, pa.string()), pa.array(errors, pa.int64()), b.column("label"), pa.array(sha, pa.string())],
                names=["vec_id", "code", "error", "label", "codebooks_sha256"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    coded = written(rows.mapInArrow(run, f"vec_id long, code string, error long, label {kind}, codebooks_sha256 string"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")))
    discard(rows)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
