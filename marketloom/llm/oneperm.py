"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

Every five-word shingle of a text is hashed once. The hash's first bits are its bin, the least hash of a bin is the bin's
minimum, and of that the last bits are kept. An empty bin takes the bits of the first bin with shingles in a random
sequence of its own (optimal densification); past TRIES places that sequence goes on as a random order of all bins, so
that it always ends. Bits are packed in binary and shown in hexadecimal. Likeness is the share of bins that agree,
less what chance makes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

#: Bins, bits kept of each, words of a shingle; places of an empty bin's sequence before the order of all bins.
BINS, BITS, WORDS, TRIES = 256, 4, 5, 12
#: Rows whose order is found in one task.
RANGE_ROWS = 1_000_000
GAPS = r"[\x20\x09-\x0D]+"


def let(value: Column, f) -> Column:
    """f(value), with value computed once for each row, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def _shingles(text: Column, words: int) -> Column:
    """Hashes of the shingles, one for each place; of fewer words the one of all, of none nothing."""
    hashes = F.transform(F.array_remove(F.split(text, GAPS), ""), lambda w: F.xxhash64(w))
    whole = lambda h: F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.expr("cast(array() as array<bigint>)"))
    each = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[h[i + k] for k in range(words)]))
    return let(hashes, lambda h: F.when(F.size(h) >= words, each(h)).otherwise(whole(h)))


def _minima(shingles: Column, bins: int) -> Column:
    """The least hash of each bin, in the order of signed hashes; a bin without shingles has the mark LOW."""
    low = 64 - (bins - 1).bit_length()
    marks = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.shiftleft(i.cast("long"), low).bitwiseOR(F.lit((1 << low) - 1)))
    first = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, low) != F.shiftright(F.get(s, i - 1), low)))
    return let(F.sort_array(F.concat(shingles, marks)), first)


def _filled(minima: Column, bins: int, bits: int, tries: int) -> Column:
    """The last bits of each bin's minimum as hexadecimal digits. An empty bin has the last bits of a hash of the minimum
    that it takes and of its own number, so that copies of one minimum don't agree with another's all at once. Zeros where
    all bins are empty."""
    low, digits = (1 << (64 - (bins - 1).bit_length())) - 1, bits // 4
    last = lambda x: F.hex(x.bitwiseAND(F.lit((1 << bits) - 1)))
    shown = (lambda x: F.lpad(last(x), digits, "0")) if digits > 1 else last
    values = F.transform(minima, lambda x: F.when(x.bitwiseAND(F.lit(low)) != low, x))

    def fill(values: Column, full: Column) -> Column:
        place = lambda i, a: F.pmod(F.xxhash64(i, F.lit(a)), F.lit(bins)).cast("int")
        rest = lambda i: F.array_min(F.transform(full, lambda j: F.struct(F.xxhash64(i, j, F.lit(-1)).alias("r"), values[j].alias("v"))))["v"]
        taken = lambda i: F.coalesce(*[values[place(i, a)] for a in range(tries)], rest(i))
        some = F.transform(values, lambda v, i: shown(F.coalesce(v, F.xxhash64(taken(i), i))))
        return F.when(F.size(full) == 0, F.array_repeat(F.lit("0" * digits), bins)).otherwise(some)

    full = lambda values: F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda j: values[j].isNotNull())
    return let(values, lambda v: let(full(v), lambda f: fill(v, f)))


def packed(text: Column, bins: int = BINS, bits: int = BITS, words: int = WORDS, tries: int = TRIES) -> Column:
    """The fingerprint of a text in binary, bits of each bin side by side; a null text counts as empty. bins: a power of
    two; bits: 4, 8, 16 or 32; bins * bits: a multiple of 64."""
    assert bins & (bins - 1) == 0 and bits in (4, 8, 16, 32) and bins * bits % 64 == 0
    return F.unhex(F.array_join(_filled(_minima(_shingles(F.coalesce(text, F.lit("")), words), bins), bins, bits, tries), ""))


def shown(fingerprint: Column) -> Column:
    return F.lower(F.hex(fingerprint))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimate of the Jaccard similarity: of bins that agree, less the 2**-bits of the others that agree by chance."""
    ones = sum(1 << k for k in range(0, 64, bits))
    ones -= 1 << 64 if ones >> 63 else 0
    word = lambda x, w: F.conv(F.hex(F.substring(x, w * 8 + 1, 8)), 16, -10).cast("long")

    def unlike(w: Column) -> Column:
        """Bins that differ in the w-th 64 bits: each bin's bits are folded into its last one, in steps that double."""

        def folded(z: Column, step: int) -> Column:
            return z if step == bits else let(z.bitwiseOR(F.shiftrightunsigned(z, step)), lambda y: folded(y, 2 * step))

        return let(word(a, w).bitwiseXOR(word(b, w)), lambda z: F.bit_count(folded(z, 1).bitwiseAND(F.lit(ones))))

    other = F.aggregate(F.sequence(F.lit(0), F.lit(bins * bits // 64 - 1)), F.lit(0), lambda n, w: n + unlike(w))
    chance = 2.0**-bits
    return F.greatest(F.lit(0.0), ((F.lit(float(bins)) - other) / bins - chance) / (1 - chance))


def _followed(ids: DataFrame) -> DataFrame:
    """ids (row, n_chars) with before, the row that each follows by descending row, and before_chars; the first follows
    the last. Ranges of rows are ordered apart, and their ends are tied together."""
    spark = ids.sparkSession
    ranges = max(-(-ids.count() // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = written(ids.repartitionByRange(ranges, F.col("row").desc()).withColumn("range", F.spark_partition_id()))
    inner = Window.partitionBy("range").orderBy(F.col("row").desc())
    chained = dealt.withColumns({"before": F.lag("row").over(inner), "before_chars": F.lag("n_chars").over(inner), "nth": F.row_number().over(inner)})
    # A row for each range: the last row of the range before it, round the end.
    order = Window.orderBy("range")
    last = dealt.groupBy("range").agg(F.min(F.struct("row", "n_chars")).alias("last"))
    round_end = F.last("last").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = last.select("range", F.coalesce(F.lag("last").over(order), round_end).alias("end"))
    firsts = chained.where("nth = 1").join(ends, "range").select("row", F.col("end.row").alias("before"), F.col("end.n_chars").alias("before_chars"))
    out = written(chained.where("nth > 1").select("row", "before", "before_chars").unionByName(firsts))
    discard(dealt)
    return out


def fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: a row for each row of docs.

    The edited text has its last floor(n_chars / 3) characters replaced by as many of the next document, or by all of it
    if that is shorter. Next is by descending doc_id, after the last the first; a single document follows itself; of equal
    ids the one of the greater text hash comes first, null ids come last; equal rows count as one document and give equal
    rows. A null text counts as empty; texts without words have a fingerprint of zeros, and so a likeness of 1 to each
    other. Likeness is never below 0 or above 1. Texts are worked on whole, however long. An empty table gives no rows.
    Other columns are not looked at, whatever their names.
    """
    text = F.coalesce("text", F.lit(""))
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.length(text).cast("long").alias("n"))
    ids = written(docs.select(row.alias("row")).groupBy("row").agg(F.count("*").alias("copies")).select("row", F.col("row.n").alias("n_chars"), "copies"))
    follows, repeated = _followed(ids.drop("copies")), not ids.where("copies > 1").isEmpty()
    discard(ids)
    # Both joins below read one exchange of the texts.
    keyed = docs.select(row.alias("row"), text.alias("text"), packed(text, bins, bits, words).alias("own"))
    heads = (keyed.dropDuplicates(["row"]) if repeated else keyed).join(follows, "row")
    heads = heads.select(F.col("before").alias("row"), F.expr("left(text, cast(before_chars div 3 as int))").alias("head"), F.col("own").alias("next"))
    edited = F.expr("concat(left(text, cast(row.n - row.n div 3 as int)), head)")
    both = keyed.join(heads, "row").select("row", "own", "next", edited.alias("edited"))
    seen = lambda p: F.struct(shown(p).alias("shown"), likeness(F.col("own"), p, bins, bits).alias("near"))
    both = both.select("row", "own", "next", F.sha2("edited", 256).alias("edited_sha256"), let(packed(F.col("edited"), bins, bits, words), seen).alias("seen"))
    return both.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.n").alias("n_chars"), "edited_sha256", shown(F.col("own")).alias("fingerprint"), F.col("seen.shown").alias("edited_fingerprint"),
        F.col("seen.near").alias("near_edited"), likeness(F.col("own"), F.col("next"), bins, bits).alias("near_next"),
    )
