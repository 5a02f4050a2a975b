"""The corpus operators against brute force, on small tables with nulls, repeats, ties and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketloom.llm import common, graphdedup, lmscore, packing, pieces, pii, simhash, suffix, tokencount, topk, toxicity

WORDS = "the a of lamp river stone green walks über café naïve quick 12 3.5 don't (yes) end.".split()
LONG = "x" * 5000


def texts(seed=0, n=40):
    rng = random.Random(seed)
    made = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 120))) for _ in range(n)]
    base = " ".join(rng.choice(WORDS) for _ in range(150))
    near = [base, base + " tail", base.replace("lamp", "lamp", 1), base.upper()]
    return [None, "", " \t\n", "one", "two words", LONG, *made, made[0], made[0], *near, "line\n\nline  two three", "日本語 テスト 😀", "a\x1cb \x85 c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "clash", "clash") for i, t in enumerate(texts())]
    rows.append(rows[3])  # a row twice
    names = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string"
    return spark.createDataFrame(rows, names).repartition(3)


def rows_of(df):
    return df.collect()


def text_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def empty_like(docs):
    return docs.where("false")


# --- SimHash -------------------------------------------------------------------------------------------------------------


def slow_fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_simhash(spark, docs):
    got = rows_of(simhash.near_duplicates(docs))
    t = text_of(docs)
    fp = {i: slow_fingerprint(x) for i, x in t.items()}
    assert len(got) == docs.count()
    assert all(r["fingerprint"] == f"{fp[r['doc_id']]:016x}" for r in got)
    low = linked(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2])
    assert all(r["component_id"] == low[r["doc_id"]] for r in got)
    assert rows_of(simhash.near_duplicates(empty_like(docs))) == []


@pytest.mark.parametrize("shape", ["random", "balls"])
def test_gray_index_and_ranges(spark, monkeypatch, shape):
    monkeypatch.setattr(simhash, "RANGE_ROWS", 64)
    monkeypatch.setattr(simhash, "VISITORS", 100)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    if shape == "balls":  # few centres, many within a few bits
        x = x[:6].repeat(60) ^ (np.uint64(1) << rng.integers(0, 62, 360, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 62, 360, dtype=np.uint64))
    x = np.unique(x)
    order = x[np.argsort(simhash.gray_rank(x))]
    found = {(int(x[q]), int(order[t])) for qs, ts in simhash.GrayIndex(order).search(x, 2) for q, t in zip(qs, ts)}
    near = {(int(a), int(b)) for a in x for b in x if int(a ^ b).bit_count() <= 2}
    assert found == near
    fps = common.written(spark.createDataFrame([(int(v),) for v in x], "fp long"))
    joined = {r["node"]: r["component"] for r in common.components(simhash.links(fps, 2)).collect()}
    low = linked([int(v) for v in x], [p for p in near if p[0] < p[1]])
    assert {n: joined.get(n, n) for n in low} == low


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201)] * 3 + [(7, 7)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


# --- toxicity ------------------------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(3)
    bad = ["zorgo", "idiot", "frumpka"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(WORDS) for _ in range(30)] + ([rng.choice(bad)] * rng.randrange(1, 3) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic) if rng.random() > 0.03 else 1 - int(toxic)))
    rows += [(9000, None), (9001, ""), (None, "zorgo")]
    labels += [(None, 1, 1), (5, None, None), (77777, 0, 1)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rows_of(toxicity.score(docs, labels))
    assert len(got) == len(rows)
    known = {r["doc_id"]: r for r in got}
    out = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert known[9000]["score"] == known[9001]["score"] < 0.5
    kept = toxicity.kept(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns and 9000 in [r["doc_id"] for r in kept.collect()]
    # Held-out labels have no part in it.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in rows_of(toxicity.score(docs, flipped))}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in got)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine"), (3, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["predicted"] for r in rows_of(toxicity.score(docs, none))} == {1: 1, 2: 0, 3: 0}
    assert rows_of(toxicity.score(empty_like(docs), none)) == []
    some = spark.createDataFrame([(k, 1, k % 2) for k in range(9)], "doc_id long, quality int, toxic int")
    assert rows_of(toxicity.score(empty_like(docs), some)) == []
    odd = docs.unionByName(spark.createDataFrame([(4, "you idiot " * 200_000), (4, "fine")], docs.schema)).withColumns({"toxic": F.lit("clash"), "score": F.lit("clash")})
    assert sorted((r["doc_id"], r["predicted"]) for r in rows_of(toxicity.score(odd, none))) == [(1, 1), (2, 0), (3, 0), (4, 0), (4, 1)]


def test_label_model_finds_rates_and_repeated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    votes = np.stack([np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.05), np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.1)] * 1).T
    votes = np.hstack([votes, votes[:, :1]]).astype(float)
    gold = np.where(rng.random(4000) < 0.9, y, ~y).astype(int)
    post, rates, share = toxicity.label_model(votes, gold)
    assert abs(rates[0, 0] - 0.8) < 0.06 and abs(rates[1, 0] - 0.05) < 0.03
    assert share[[0, 2]] == pytest.approx([0.5, 0.5], abs=0.02) and share[1] > 0.95
    assert ((post > 0.5) == y).mean() > 0.93
    gold[2000:] = -1  # half of the rows have no label and are judged all the same
    post, rates, _ = toxicity.label_model(votes, gold)
    assert abs(rates[0, 0] - 0.8) < 0.08 and ((post > 0.5) == y)[2000:].mean() > 0.9


def test_label_model_over_all_documents_is_the_one_in_memory(spark):
    rng = np.random.default_rng(1)
    y = rng.random(600) < 0.3
    votes = np.stack([np.where(y, rng.random(600) < a, rng.random(600) < b) for a, b in ((0.8, 0.05), (0.6, 0.1), (0.7, 0.2))]).T.astype(float)
    gold = np.where(rng.random(600) < 0.5, y.astype(int), -1)
    start = toxicity.Rates(0.2, np.full(3, 0.6), np.full(3, 0.1), np.ones(3), 0.9)
    rows = [(np.packbits(v.astype(np.uint8)).tobytes(), int(g), 1) for v, g in zip(votes, gold)]
    patterns = spark.createDataFrame(rows, "bits binary, gold int, n long").groupBy("bits", "gold").agg(F.sum("n").alias("n"))
    got = toxicity._next_rates(patterns, start, True)
    post = start.posterior(votes, gold)
    left = votes - np.outer(post, start.on) - np.outer(1 - post, start.off)
    sd = np.sqrt((left**2).mean(axis=0))
    assert got.on == pytest.approx((post @ votes + 0.5) / (post.sum() + 1)) and got.p == pytest.approx(post.mean())
    assert got.share == pytest.approx(1 / ((left.T @ left / 600 / np.outer(sd, sd)) ** 2).sum(axis=1), abs=1e-4)
    assert got.trust == pytest.approx(np.clip(np.where(gold == 1, post, 1 - post)[gold >= 0].mean(), 0.6, toxicity.TRUST))


def test_words_of_any_length_vote():
    memo = toxicity._Memo(["=" + "x" * 80, "xxx"])
    assert toxicity._counts("x" * 80, memo, 2)[0][:2].tolist() == [1, 1] and not memo


# --- personal data -------------------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_spans(t):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))]
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_pii(spark):
    cases = [
        "mail a.b+c@x-y.example.com, a@b.c@d.e @x.y q@@z.w a@b..c", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.004 12.34", "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004x", "+1 (499) 555-6503. +12 +1-2345678 +49 30 123456)",
        "IBAN GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33", "call 499-555-6503 now, and much later, far away from any word of that sort: 499-555-6503 and nothing else at all", "é" * 30 + " a@b.co", "1" * 3000, "a" * 3000 + "@b.c", None, "",
    ]
    rng = random.Random(5)
    cases += ["".join(rng.choice("a1.@+- ()4\n") for _ in range(200)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = {r["doc_id"]: r for r in rows_of(pii.find(docs))}
    for i, t in enumerate(cases):
        want = slow_spans(t)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]
        assert set(filter(None, listed.split(","))) <= set(got[i]["spans"].split(","))
    assert [x.split(":")[0] for x in got[4]["spans"].split(",")] == ["iban"]
    assert got[5]["spans"] == "call:5:17"
    assert got[3]["clean_text"].startswith("<PHONE>. ")
    assert rows_of(pii.find(empty_like(docs))) == []
    assert pii.redact(docs).where("text is null").first()["clean_text"] is None


# --- SentencePiece -------------------------------------------------------------------------------------------------------


def test_sentencepiece(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = rows_of(pieces.encode_decode(docs, path))
    t = text_of(docs)
    assert len(got) == docs.count()
    for r in got:
        ids = lib.encode(t[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert rows_of(pieces.encode_decode(empty_like(docs), path)) == []


def test_sentencepiece_rows_and_heap_agree():
    codec = pieces.Codec(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    chunks = ["▁" + "".join(rng.choice("abcdefghin.,é日▁ß") for _ in range(rng.randrange(1, 40))).replace("▁", "x") for _ in range(400)]
    codec.learn(chunks)
    for c in chunks:
        assert codec.memo[c] == codec._spelled(c, codec._heap(c))
        assert np.frombuffer(codec.memo[c], "<u2").tolist() == codec.library.encode(c[1:])


# --- top k ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["random", "ties", "clusters", "huge"])
def test_top_k(spark, monkeypatch, shape):
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8)) / 3
    if shape == "ties":
        x = rng.integers(-1, 2, (300, 8)) / 4
    if shape == "clusters":
        x = rng.normal(size=(300, 8)) / 50 + np.eye(8)[rng.integers(0, 8, 300)]
    if shape == "huge":
        x = x * 1e9
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1020, [1.0] * 7 + [None]), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (None, [1.0] * 8), (1080, [1.0, 2.0]), (1100, []), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(3)
    got = {}
    for r in rows_of(topk.top_k(df, df.where("vec_id % 20 = 0"), k=5)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    q = [[int(np.floor(64 * v)) for v in r] for r in x]
    want = {}
    for a in range(0, 300, 20):
        scored = sorted((-max(min(sum(m * n for m, n in zip(q[a], q[b])), 2**63 - 1), -(2**63)), b) for b in range(300) if b != a)[:5]
        want[a] = [(k + 1, b, -s) for k, (s, b) in enumerate(scored)]
    if shape == "huge":  # scores beyond a long are cut to its range, and tie there
        assert set(got) == set(want)
        for a, found in got.items():
            score = {b: max(min(sum(m * n for m, n in zip(q[a], q[b])), 2**63 - 1), -(2**63)) for b in range(300) if b != a}
            assert all(s == score[b] for _, b, s in found) and sorted((-s for *_, s in found)) == sorted(-s for s in score.values())[:5]
    else:
        assert {k: sorted(v) for k, v in got.items()} == want
    assert rows_of(topk.top_k(empty_like(df), empty_like(df))) == []


def test_threshold_stops_on_structured_vectors():
    """Where a few components decide the scores, the bound stops the reading after a small part of the rows."""
    rng = np.random.default_rng(12)
    c = np.floor(64 * rng.normal(size=(4000, 8)) * 0.5 ** np.arange(8))
    c[:200] = np.floor(c[:200] * 6)
    q = c[:50] + 1
    ids, read = np.arange(4000), []
    for i, found, score, n in topk.threshold_search(ids, c, np.arange(50), q, 5):
        s = c @ q[i]
        s[i] = -np.inf
        best = np.lexsort((ids, -s))[:5]
        assert found.tolist() == best.tolist() and score.tolist() == s[best].tolist()
        read.append(n)
    assert np.mean(np.array(read) < 4000) > 0.8 and np.median(read) < 1500


def test_top_k_of_a_zero_query():
    c = np.random.default_rng(2).integers(-9, 10, (300, 3)).astype(float)
    ids = np.arange(300)[::-1].copy()
    c[:5] = -20
    c[5:10] = 20
    found = {i: (v.tolist(), s.tolist()) for i, v, s, _ in topk.threshold_search(ids, c, np.array([0, 7000]), np.zeros((2, 3)), 5)}
    assert found == {0: ([1, 2, 3, 4, 5], [0] * 5), 1: ([0, 1, 2, 3, 4], [0] * 5)}



# --- language models -----------------------------------------------------------------------------------------------------


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "HOT", 0.01)
    monkeypatch.setattr(lmscore, "PAIR", 0.004)
    monkeypatch.setattr(lmscore, "SHARE", 500)
    monkeypatch.setattr(lmscore, "CHUNK", 300)
    t = texts(9, 60)
    docs = spark.createDataFrame([(None if i == 8 else i, x) for i, x in enumerate(t)], "doc_id long, text string").repartition(3)
    docs = docs.withColumns({"target": F.lit("clash"), "part": F.lit("clash")})
    target = spark.createDataFrame([(1, "lamp river stone lamp river"), (2, None), (3, "green walks lamp river")], "item_id long, text string")
    got = rows_of(lmscore.score(docs, target))
    assert len(got) == len(t)
    split = lambda x: (x or "").encode().lower().split()
    corpora = [list(map(split, t)), [split(r["text"]) for r in target.collect()]]
    counts = [Counter(w for x in c for w in x) for c in corpora]
    totals = [sum(c.values()) for c in counts]
    known, seq = {w for c in counts for w in c}, list  # every word of either
    losses = []
    for c, total in zip(corpora, totals):
        uni = Counter(w for x in c for w in seq(x))
        big = Counter(p for x in c for p in zip(["^", *seq(x)], seq(x)))
        first = {**uni, "^": len(c)}
        losses.append(lambda a, b, uni=uni, big=big, first=first, total=total: -np.log((big[a, b] + 20 * (uni[b] + 0.5) / (total + 0.5 * (len(known) + 1))) / (first.get(a, 0) + 20)))
    by_id = {r["doc_id"]: r for r in got}
    for i, x in enumerate(corpora[0]):
        pairs = list(zip(["^", *seq(x)], seq(x)))
        n = max(1, len(pairs))
        r = by_id[None if i == 8 else i]
        assert r["n_words"] == len(pairs)
        assert r["loss_background"] == pytest.approx(sum(losses[0](*p) for p in pairs) / n)
        assert r["score"] == pytest.approx(sum(losses[1](*p) - losses[0](*p) for p in pairs) / n)
    assert rows_of(lmscore.score(empty_like(docs), target)) == []
    assert len(rows_of(lmscore.score(docs, empty_like(target)))) == len(t)


# --- suffixes ------------------------------------------------------------------------------------------------------------


def slow_cut(ts, length):
    data = [(t or "").encode() for t in ts]
    seen = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out.append((len(x), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_cuts(spark, seed):
    rng = random.Random(seed)
    alphabet = ["ab", "abcdefgh", "aé日", "abcd"][seed]
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(10, 40))) for _ in range(6)]
    ts = [None, "", "ab", "a" * 60, "ab" * 30]
    for _ in range(50):
        ts.append("".join(rng.choice([rng.choice(passages), rng.choice(passages)[rng.randrange(5) :], rng.choice(alphabet) * rng.randrange(4)]) for _ in range(rng.randrange(1, 5))))
    ts.append(ts[7])
    docs = spark.createDataFrame([(None if i == 9 else i, t, "clash", 5) for i, t in enumerate(ts)] + [(5, ts[5], "clash", 5)], "doc_id long, text string, kept string, extra int").repartition(3)
    got = {r["doc_id"]: r for r in rows_of(suffix.cut(docs, length=12, gram=4))}
    want = slow_cut([*ts, ts[5]], 12)
    for i in range(len(ts)):
        r = got[None if i == 9 else i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[i], i
        assert r["extra"] == 5
    # The same through shorter passages, which are counted too: one word each here, so that none is left out.
    shorter = slow_cut([*ts, ts[5]], 7)
    for r in rows_of(suffix.cut(docs, 12, 4, passage=(7, 3, 1))):
        i = 9 if r["doc_id"] is None else r["doc_id"]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[i], i
        assert (r["n_passage_bytes"], r["n_passages"]) == shorter[i][1:3], i
    assert rows_of(suffix.cut(empty_like(docs), 12, 4)) == rows_of(suffix.cut(empty_like(docs), 12, 4, passage=(7, 3, 1))) == []


@pytest.mark.parametrize("n_words", [50, 51, 55, 60, 70])
def test_passages_by_their_words(spark, n_words):
    """Passages of 50 words and more are passages, whether they have 400 bytes or not; those of 400 bytes go."""
    rng = random.Random(n_words)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages, lines = [text(n_words) for _ in range(10)], [text(45) for _ in range(10)]
    ts = [f"{text(60)} {p} {text(80)}" for p in [*passages, *lines] * 2] + [text(150) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in rows_of(suffix.cut(docs, passage=(240, 64, 50)))}
    want = slow_cut(ts, 400)
    for i in range(len(ts)):
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (want[i][1], want[i][3])
        assert (got[i]["n_passages"] > 0) == (i < 40 and i % 20 < 10), i


def test_suffix_text_longer_than_a_buffer(spark, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(suffix, "BUFFER", 4096)
    monkeypatch.setattr(suffix, "_POS", np.uint64(8191))
    monkeypatch.setattr(suffix, "_UP", [])
    passage = "".join(rng.choice("abcdefgh") for _ in range(700))
    filler = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    ts = [filler(3600) + passage + filler(5000) + passage[:450], filler(10) + passage[100:] + filler(9000)]
    first, last, anchor, g = suffix.runs(np.frombuffer((ts[1][:4000]).encode(), np.uint8), np.array([4000]), 400, 100)
    assert first[0] == 0 and last[-1] == 3600 and (anchor >= first).all() and (anchor <= first + 300).all()
    docs = spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows_of(suffix.cut(docs))}
    assert [got[i] for i in range(2)] == slow_cut(ts, 400)


# --- token counts --------------------------------------------------------------------------------------------------------


def test_token_counts(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    rows = {}
    for r in rows_of(tokencount.count(docs, path, ("source", "text"))):
        rows.setdefault(r["doc_id"], []).append(r)
    for i, t in text_of(docs).items():
        full = "s\n" + (t or "")
        found = sorted(rows[i], key=lambda r: r["start"])
        found = found[:: 2 if i == 3 else 1]  # that row is there twice
        assert found[0]["start"] == 0 and found[-1]["stop"] == len(full)
        own = [0] * len(found)
        for a, b in lib.encode(full, add_special_tokens=False).offsets:
            shares = [max(0, min(b, r["stop"]) - max(a, r["start"])) for r in found]
            own[int(np.argmax(shares))] += 1
        assert [r["n_tokens"] for r in found] == own
    assert rows_of(tokencount.count(empty_like(docs), path, ("text",))) == []


def test_token_that_crosses_goes_to_the_larger_share():
    owned, crossing = tokencount.attribute(np.array([0, 2, 5, 7]), np.array([2, 5, 7, 9]), np.array([0, 3, 6]))
    assert owned.tolist() == [1, 2, 1] and crossing.tolist() == [0, 2, 0]
    owned, _ = tokencount.attribute(np.array([0]), np.array([4]), np.array([0, 2]))
    assert owned.tolist() == [1, 0]


# --- vectors -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("split", [False, True])
def test_embedding_dedup(spark, monkeypatch, split):
    monkeypatch.setattr(graphdedup, "SHARD", 100)
    if split:  # shards of several graphs and several groups of queries
        monkeypatch.setattr(graphdedup, "GRAPH", 60)
        monkeypatch.setattr(graphdedup, "ASKED", 90)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 16))
    x[50:120] = x[50] + rng.normal(size=(70, 16)) / 12  # a large group
    x[130:140] = x[130] * np.arange(1, 11)[:, None]  # the same direction
    x[150:155] = x[150]
    x[160:164] = x[160] + rng.normal(size=(4, 16)) / 8
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0] * 15 + [None]), (504, []), (505, [1.0, 0.0]), (506, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("kept", F.lit("clash")).repartition(3)
    got = {r["vec_id"]: r for r in rows_of(graphdedup.near_duplicates(df))}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    low = linked(range(300), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    found = sum(got[i]["n_links"] for i in range(300))
    assert found >= 0.99 * near.sum()
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(300))
    assert all(got[i]["component_id"] == low[i] and got[i]["kept"] == (low[i] == i) for i in range(300))
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(500, 505))
    assert [got[i]["component_id"] for i in (505, 506)] == [505, 505]
    assert rows_of(graphdedup.near_duplicates(empty_like(df))) == []


def test_audit_counts_classes_apart_from_a_large_group(spark):
    rng = np.random.default_rng(3)
    hot = np.eye(16)[0] + rng.normal(size=(150, 16)) / 100
    small = np.repeat(np.eye(16)[1:11], 2, axis=0) + rng.normal(size=(20, 16)) / 100
    classes = spark.createDataFrame([(k, 1, v.tolist()) for k, v in enumerate(np.concatenate([hot, small]))], "id long, n long, x array<double>")
    links = lambda few: spark.createDataFrame([(k, 149) for k in range(150)] + [(k, few) for k in range(150, 170)], "a long, links long")
    assert graphdedup.audit(classes, links(1), 0.9) == 1.0
    assert graphdedup.audit(classes, links(0), 0.9) == 0.0  # 20 of 22,370 links


def test_embedding_dedup_ends_with_the_exact_search(spark, monkeypatch):
    monkeypatch.setattr(graphdedup, "audit", lambda *_: 0.0)
    monkeypatch.setattr(graphdedup, "range_search", lambda *_: iter(()))
    monkeypatch.setattr(graphdedup, "SHARD", 20)
    x = np.repeat(np.random.default_rng(4).normal(size=(30, 16)), 2, axis=0) + np.random.default_rng(5).normal(size=(60, 16)) / 50
    got = rows_of(graphdedup.near_duplicates(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(k, 1, k // 2 * 2) for k in range(60)]


# --- packing -------------------------------------------------------------------------------------------------------------


def test_packing(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    long = docs.unionByName(docs.select("doc_id", F.repeat("text", F.lit(60)).alias("text"), *docs.columns[2:]).withColumn("doc_id", F.col("doc_id") + 1000))
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in text_of(long).items()}
    got = rows_of(packing.pack(long, path))
    pieces_of, sequences = {}, {}
    for r in got:
        piece = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(piece) == r["length"] > 0 and zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces_of.setdefault(r["doc_id"], Counter()).update(range(r["start"], r["start"] + r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, c in pieces_of.items():
        assert set(c) == set(range(len(ids[i]))) and set(c.values()) == {2 if i in (3, 1003) else 1}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # nothing is padded
    assert rows_of(packing.pack(empty_like(docs), path)) == []


def test_packing_plan_uses_no_more_than_there_is():
    rng = np.random.default_rng(0)
    combos = packing.combinations()
    assert (combos @ np.arange(32) == 32).all() and (combos.sum(axis=1) <= packing.DEPTH).all()
    for h in (rng.integers(0, 1000, 32), np.zeros(32, int), np.eye(32, dtype=int)[16] * 5001, rng.integers(0, 2, 32)):
        h[0] = 0
        chosen = packing.plan(h)
        used = sum((n * c for c, n in chosen), np.zeros(32, int))
        assert (used <= h).all()
    x = packing.nnls(np.array([[1.0, 0], [0, 1], [1, 1]]), np.array([1.0, -1, 1]))
    assert x == pytest.approx([1.0, 0.0])


def test_word_encoder_is_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), packing.WordEncoder(path)
    odd = [*filter(None, texts()), "ΑΣ ΣΑ", "İx", "a​b", "<|endoftext|> a <|startoftext|>b", "don't I'LL", "ﬁ½²", "é ́", "a_b __"]
    assert [x.tolist() for x in own.encode([t.encode() for t in odd])] == [lib.encode(t, add_special_tokens=False).ids for t in odd]
