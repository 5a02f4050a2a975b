"""Vector codes, one-permutation fingerprints and cross-tokenizer alignment against brute force."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketloom.llm import codes, crosstokens, oneperm

WORDS = "the a of lamp river stone green walks über café naïve quick 12 3.5 don't (yes) end.".split()
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


# --- vector codes --------------------------------------------------------------------------------------------------------


def slow_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(scale * Fraction(v)) for v in x], label) for i, x, label in rows if x and all(v is not None and math.isfinite(v) for v in x)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda x, p: x[p * w : p * w + w]
    books = [[cut(x, p) for _, x, _ in kept[:entries]] for p in range(parts)]
    near = lambda x, p: min((sum((a - b) ** 2 for a, b in zip(cut(x, p), e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        of = [[near(x, p)[1] for p in range(parts)] for _, x, _ in kept]
        books = [
            [[sum(v) // len(v) for v in zip(*own)] if (own := [cut(x, p) for (_, x, _), o in zip(kept, of) if o[p] == k]) else e for k, e in enumerate(books[p])]
            for p in range(parts)
        ]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    found = [[near(x, p) for p in range(parts)] for _, x, _ in kept]
    errors = [sum(e for e, _ in f) for f in found]
    by = Counter()
    for (_, _, label), e in zip(kept, errors):
        by[label] += e
    cap = lambda v: min(v, (1 << 63) - 1)
    return [
        {"vec_id": i, "code": "".join(f"{k:02x}" for _, k in f), "error": cap(e), "label_error": cap(by[label]), "codebooks_sha256": sha}
        for (i, _, label), f, e in zip(kept, found, errors)
    ]


def vectors(spark, rows, extra=True):
    names = "vec_id long, embedding array<double>, label int" + (", code string, error long, d int" if extra else "")
    return spark.createDataFrame([(*r, "x", 7, 3) if extra else r for r in rows], names).repartition(3)


@pytest.mark.parametrize("size", [1.0, 1e7, 1e14, 1e200])
def test_codes_are_the_plain_loop(spark, size):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-size, size) for _ in range(16)], rng.choice([1, 2, None])) for i in range(60)]
    rows += [(100, None, 1), (101, [], 1), (102, [None] + [0.0] * 15, 1), (103, [float("nan")] + [0.0] * 15, 1), (104, [float("inf")] * 16, None)]
    rows += [rows[3], rows[3], (None, rows[5][1], 2), (200, rows[6][1], 2), (201, [0.0] * 16, None), (0, rows[7][1], 1)]
    got = rows_of(codes.compress(vectors(spark, rows)))
    want = sorted(slow_codes(rows), key=str)
    if size > 1e100:  # sums of errors are cut at a long
        assert [r["code"] for r in got] == [r["code"] for r in want] and {r["codebooks_sha256"] for r in got} == {want[0]["codebooks_sha256"]}
    else:
        assert got == want


def test_codes_of_few_vectors_and_of_none(spark):
    rows = [(2, [0.5] * 8, None), (1, [0.25] * 8, None)]
    assert rows_of(codes.compress(vectors(spark, rows, False))) == sorted(slow_codes(rows), key=str)
    assert rows_of(codes.compress(vectors(spark, rows).where("false"))) == []


def test_codes_of_other_lengths_stand_alone(spark):
    a = [(i, [i / 7 - j for j in range(8)], 1) for i in range(30)]
    b = [(100 + i, [i / 3 + j for j in range(24)], 2) for i in range(30)]
    got = rows_of(codes.compress(vectors(spark, a + b)))
    assert got == sorted(slow_codes(a) + slow_codes(b), key=str)


@pytest.mark.parametrize("top", [10, 1 << 20, 1 << 29, 1 << 45, 1 << 70])
def test_products_by_limbs_are_exact(top):
    rng = random.Random(top)
    draw = lambda n, m: np.array([[rng.randrange(-top, top + 1) for _ in range(m)] for _ in range(n)], np.int64 if top < 1 << 62 else object)
    a, b = draw(7, 33), draw(33, 5)
    assert codes.exact_product(a, b).tolist() == (a.astype(object) @ b.astype(object)).tolist()
    if top < 1 << 62:
        assert all(np.abs(x).max() < 1 << 12 for x in codes.limbs(a, 12))
        assert sum(x.astype(object) * (1 << 12 * k) for k, x in enumerate(codes.limbs(a, 12))).tolist() == a.tolist()


# --- fingerprints --------------------------------------------------------------------------------------------------------


def texts(n=60, seed=0):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 700))) for _ in range(n)]
    return [None, "", " \t\n", "one", "two words", "x" * 5000, *made, made[0], "line\n\nline  two three", "日本語 テスト 😀 é", "word " * 30_000]


def shingles(text, k=5):
    words = [w for w in "".join(" " if c in "\x20\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def similar(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edits(rows):
    """Text, edited text and next text of each (doc_id, text), by descending doc_id."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        m = len(t) // 3
        out[i] = (t, t[: len(t) - m] + after[:m], after)
    return out


def fingerprints(spark, rows, parts=4):
    full = [(i, t, 1, "x", 0.5) for i, t in rows]
    return oneperm.fingerprints(spark.createDataFrame(full, "doc_id long, text string, n_chars int, fingerprint string, row double").repartition(parts))


@pytest.mark.parametrize("ranges", [1_000_000, 7])
def test_fingerprints(spark, monkeypatch, ranges):
    monkeypatch.setattr(oneperm, "RANGE_ROWS", ranges)
    rows = [*enumerate(texts()), (None, "no id at all")]
    got = {r["doc_id"]: r for r in fingerprints(spark, rows).collect()}
    want = edits(rows)
    assert got.keys() == want.keys()
    by_text, wrong = {}, []
    for i, (text, edited, after) in want.items():
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for t, f in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert len(f) == oneperm.BINS * oneperm.BITS // 4 and by_text.setdefault(t, f) == f
        wrong += [r["near_edited"] - similar(text, edited), r["near_next"] - similar(text, after)]
    assert max(map(abs, wrong)) < 0.17 and np.sqrt(np.mean(np.square(wrong))) < 0.05
    # Likeness is that of the fingerprints shown.
    for i, (text, _, after) in want.items():
        same = sum(a == b for a, b in zip(got[i]["fingerprint"], by_text[after]))
        assert abs(got[i]["near_next"] - max(0, (same / oneperm.BINS - 1 / 16) / (15 / 16))) < 1e-9


def test_fingerprints_are_unbiased(spark):
    """Pairs of a known similarity: the mean of the estimates meets it, for short and long texts."""
    rng = random.Random(1)
    for size, tolerance in ((12, 0.05), (100, 0.02), (1500, 0.01)):
        rows = []
        for i in range(60):
            words = [str(rng.randrange(10**9)) for _ in range(size)]
            other = words[: size * 3 // 4] + [str(rng.randrange(10**9)) for _ in range(size // 4)]
            rows.append((" ".join(words), " ".join(other)))
        df = spark.createDataFrame(rows, "a string, b string")
        got = df.select(oneperm.likeness(oneperm.packed(F.col("a")), oneperm.packed(F.col("b"))).alias("s")).collect()
        assert abs(np.mean([r["s"] for r in got]) - np.mean([similar(*r) for r in rows])) < tolerance


def test_fingerprints_of_repeats_one_row_and_none(spark):
    same = fingerprints(spark, [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "x y z")]).collect()
    assert len(same) == 3 and len({tuple(r) for r in same}) == 2
    five = next(r for r in same if r["doc_id"] == 5)
    assert five["edited_sha256"] == hashlib.sha256(b"a b c d ex y").hexdigest()[:64] or five["edited_sha256"] == hashlib.sha256("a b c d e f g"[:9].encode() + b"x y ").hexdigest()
    (one,) = fingerprints(spark, [(1, "abcdef")]).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0
    assert fingerprints(spark, [(1, "a")]).where("doc_id > 1").count() == 0
    assert oneperm.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_fingerprints_run_no_python(spark):
    plan = fingerprints(spark, [(1, "a b"), (2, "c d")])._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- two tokenizers ------------------------------------------------------------------------------------------------------


def slow_alignment(rows):
    import sentencepiece

    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    docs = []
    for i, t in rows:
        groups = []
        if t:
            ea = a_lib.encode(" " + t, add_special_tokens=False)
            eb = b_lib.encode(t)
            ta = [bytes(byte_of[c] for c in x) for x in ea.tokens]
            names = [b_lib.id_to_piece(x) for x in eb]
            tb = [bytes([int(n[3:5], 16)]) if b_lib.is_byte(x) else n.replace("▁", " ").encode() for x, n in zip(eb, names)]
            if b"".join(ta) == b"".join(tb) == (" " + t).encode():
                x = y = 0
                left, right, ends_b, at = [], [], {}, 0
                for k, piece in enumerate(tb):
                    at += len(piece)
                    ends_b[at] = k + 1
                at = 0
                for k, piece in enumerate(ta):
                    at += len(piece)
                    if at in ends_b:
                        groups.append((ea.ids[x : k + 1], eb[y : ends_b[at]]))
                        x, y = k + 1, ends_b[at]
        docs.append((i, groups))
    count = Counter(p for _, groups in docs for p in {(a, b) for l, r in groups for a in l for b in r})
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, groups in docs:
        links = [(a, b) for l, r in groups for a in l for b in r]
        text = ";".join(",".join(map(str, l)) + "|" + ",".join(map(str, r)) for l, r in groups)
        out.append({
            "doc_id": i, "n_a": sum(len(l) for l, _ in groups), "n_b": sum(len(r) for _, r in groups), "n_groups": len(groups), "n_links": len(links),
            "n_best": sum(count[p] == best[p[0]] for p in links), "count_sum": sum(count[p] for p in links), "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if groups else "",
        })
    return sorted(out, key=str)


ODD = [
    None, "", " ", "\n", "\n foo", "a\r\nb\t c", "with ▁ sign", "<|endoftext|> and </s> <s> <0x41>", "日本語テスト" * 300, "😀 naïve über　x y\x85z", "x" * 20_000,
    "a\x00b\x1cc \x1d", "ﬁ ² É", "tail  ", "  lead", "'s 't don't DON'T", "12345678901234567890", "ab" * 3000, "ͯ" * 50, "﻿bom", "word " * 5000,
]


@pytest.mark.parametrize("most", [8_000_000, 300])
def test_alignment_is_the_plain_one(spark, monkeypatch, most):
    monkeypatch.setattr(crosstokens, "PIECE", 64)
    rng = random.Random(2)
    rows = [*enumerate([*ODD, *(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 200))) for _ in range(30))])]
    rows += [rows[25], rows[25], (None, "no id"), (7, "another row of an id")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, a string, n_a int").repartition(5)
    assert rows_of(crosstokens.align(docs, A, B, most)) == slow_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert crosstokens.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_large_groups_are_counted_by_distinct_pairs(monkeypatch):
    with_ = crosstokens.encoders(A, B)
    ids = with_.encode(ODD[3:9])
    plain = crosstokens.Aligned(with_, ids).links()
    monkeypatch.setattr(crosstokens, "LISTED", 1)
    few = crosstokens.Aligned(with_, ids).links()
    total = lambda x: sum((Counter({(t, p): n}) for t, p, n in zip(*map(np.ndarray.tolist, x))), Counter())
    assert total(plain) == total(few)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 32, 50_000, dtype=np.uint32))
    known, other = keys[::2], keys[1::2]
    h = crosstokens.PerfectHash(known)
    assert sorted(h.places(known).tolist()) == list(range(len(known)))
    assert (h.places(other) == -1).all()
    assert crosstokens.PerfectHash(keys[:0]).places(keys[:3]).tolist() == [-1] * 3
