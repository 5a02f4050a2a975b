"""The stages on planted documents, and each stage's contract."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import common, nearcopies, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    syllables = "ka lo mi ren tas vor ulm esh ido pra".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
    text = lambda n=120: " ".join(word() for _ in range(n))
    passage = text(90)
    rows = [(i, text(), "en", "s", 0) for i in range(200)]
    rows[10] = (10, rows[11][1], *rows[10][2:])
    rows[12] = (12, text(40) + " " + passage + " " + text(40), *rows[12][2:])
    rows[13] = (13, text(40) + " " + passage + " " + text(40), *rows[13][2:])
    rows[14] = (14, "write to some.one@example.com about it " + rows[14][1], *rows[14][2:])
    labels = []
    for i in range(20, 200):
        toxic = i % 3 == 0
        if toxic:
            rows[i] = (i, rows[i][1] + " grumzak " + rows[i][1][:20] + " grumzak", *rows[i][2:])
        labels.append((i, 1, int(toxic)))
    rows += [(300, None, "en", "s", 0), (301, "", "en", "s", 0), (14, rows[14][1], "en", "s", 0)]
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), {r[0]: r[1] for r in rows}, passage


def test_stages(spark, corpus):
    d, text, passage = corpus
    docs = common.table(spark, d, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "suffix", "pii", "packing"]
    clean = common.written(stages["toxicity"](spark, docs, d))
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == docs.columns
    assert left == {i for i in text if not (20 <= i < 200 and i % 3 == 0)}
    single = common.written(stages["simhash"](spark, clean, d))
    ids = [r["doc_id"] for r in single.collect()]
    assert single.columns == docs.columns and sorted(ids) == sorted(left - {11, 301})
    cut = common.written(stages["suffix"](spark, single, d))
    got = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == docs.columns and cut.schema == docs.schema
    assert passage[100:300] not in got[12]["text"] + got[13]["text"] and got[12]["n_chars"] == len(got[12]["text"]) < len(text[12])
    assert got[15]["text"] == text[15]
    private = common.written(stages["pii"](spark, cut, d))
    got = {r["doc_id"]: r["text"] for r in private.collect()}
    assert private.columns == docs.columns and got[14].startswith("write to <EMAIL> about it ") and got[15] == text[15]
    packed = stages["packing"](spark, private, d)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(ids)


def test_run_is_the_stages(spark, corpus):
    d, text, _ = corpus
    out = corpus_pipeline.run(spark, d)
    assert out.select(F.count_distinct("doc_id")).first()[0] == len({i for i in text if not (20 <= i < 200 and i % 3 == 0)} - {11, 301})


def test_queries_are_named_by_operator():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


def near_stage(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(3)
    return sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()), key=str)


def edited(words, rng, share):
    """words with runs of five or fewer replaced, until the similarity to words is below share."""
    out = list(words)
    while True:
        at = rng.randrange(len(out) - 5)
        new = [*out[:at], f"edit{rng.randrange(10**9)}", *out[at + 1 :]]
        if nearcopies.similarity(*(nearcopies.shingles(" ".join(x).encode()) for x in (words, new))) < share:
            return " ".join(out)
        out = new


def test_edited_copies_go(spark):
    rng = random.Random(5)
    text = lambda n=300: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    bases = [text() for _ in range(30)]
    rows = [(k, " ".join(b)) for k, b in enumerate(bases)]
    rows += [(100 + k, edited(b, rng, 0.82)) for k, b in enumerate(bases)]
    rows += [(200 + k, " ".join([*b[:150], *text(150)])) for k, b in enumerate(bases)]  # similarity of a third: stays
    assert near_stage(spark, rows) == sorted([r for r in rows if not 100 <= r[0] < 200], key=str)


def test_a_group_is_joined_through_its_links(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    chain = [words]
    for _ in range(8):  # each is near the one before, the last is far from the first
        chain.append(edited(chain[-1], rng, 0.85).split())
    rows = [(k, " ".join(c)) for k, c in enumerate(chain)]
    assert near_stage(spark, rows) == [rows[0]]


def test_rows_are_chosen_and_not_ids(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    rows = [(None, text(1)), (None, text(2)), (None, text(3)), (9, text(3)), (5, text(4)), (5, text(5)), (5, text(6)), (4, text(6)), (7, text(7)), (7, text(7))]
    gone = [(None, text(3)), (5, text(6))]
    assert near_stage(spark, rows) == sorted({r for r in rows if r not in gone}, key=str)


CLASHES = ["kept", "clean_text", "n_bytes", "n_spans", "spans", "row", "cls", "__cls", "score", "toxic", "label", "component"]


def test_stages_keep_rows_and_columns_that_are_not_theirs(spark, corpus):
    """Null ids, null and empty texts, one very long text, a row twice and columns with the operators' own names."""
    d, _, _ = corpus
    rng = random.Random(11)
    text = lambda n=60: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = text(80)
    texts = [text(), None, "", "a b", "x" * 300_000, text() + " " + passage, passage + " " + text(), "mail a@b.cd " + text()]
    rows = [(None if i in (0, 5) else i, t, *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and out.schema == docs.schema
        got = {r["kept"]: r for r in out.collect()}
        assert all(r[c] == c + k[4:] for k, r in got.items() for c in CLASHES)
        assert set(got) == {f"kept{i}" for i in range(8)} - ({"kept2"} if name == "simhash" else set()) or (name == "simhash" and len(got) == 7), name
        if name == "suffix":
            assert all(passage[50:300] not in (got[f"kept{i}"]["text"] or "") for i in (5, 6)) and got["kept4"]["text"] == texts[4]
        if name == "pii":
            assert got["kept7"]["text"].startswith("mail <EMAIL> ") and got["kept0"]["text"] == texts[0]
        assert stage(spark, docs.where("false"), d).collect() == [], name
    packed = corpus_pipeline.pack(spark, docs, d).collect()
    assert sum(r["doc_tokens"] == 1 for r in packed) == 2 and sum(r["length"] for r in packed if r["doc_id"] == 3) == 3
    assert corpus_pipeline.pack(spark, docs.where("false"), d).collect() == []


def test_empty_labels(spark, corpus, tmp_path):
    d, text, _ = corpus
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = common.table(spark, d, "documents")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()


def test_short_passages_of_fifty_words_go(spark):
    rng = random.Random(13)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(4, 8))) for _ in range(n))
    passages, lines = [text(n) for n in (51, 53, 56, 60, 70)], [text(44) for _ in range(5)]
    rows = [(k, f"{text(70)} {p} {text(70)}", "en", "s", 0) for k, p in enumerate([*passages, *lines] * 2)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    for k, p in enumerate([*passages, *lines] * 2):
        assert (p not in got[k] and p[20:200] not in got[k]) if k % 10 < 5 else got[k] == rows[k][1]


def test_documents_that_share_a_passage_stay(spark):
    """Many texts with one passage in common meet in the same buckets; none is a near copy."""
    rng = random.Random(17)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = text(60)
    rows = [(k, f"{text(20)} {passage} {text(20)}") for k in range(150)]
    copies = [(1000 + k, t + " end") for k, t in rows[:20]]
    assert near_stage(spark, rows + copies) == sorted(rows, key=str)


def alike(n, shape, rng, size=300):
    """n texts that share a base: of mutual similarity about 0.68, or each of a similarity to the base of 0.6 to 1."""
    base, made = [f"w{i}" for i in range(size)], []
    for i in range(n):
        words, share = list(base), 0.019 if shape == "even" else rng.random() * 0.045
        for at in rng.sample(range(size), round(share * size)):
            words[at] = f"x{i}y{at}"
        made.append(" ".join(words))
    return made


@pytest.mark.parametrize("shape", ["even", "mixed"])
def test_pairs_compared_grow_with_the_rows(spark, monkeypatch, shape):
    rng, compared = random.Random(4), {}
    for n in (150, 600):
        texts = alike(n, shape, rng)
        counts, near = [], nearcopies._near
        monkeypatch.setattr(nearcopies, "_near", lambda pairs, t: counts.append(pairs.count()) or near(pairs, t))
        kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], COLUMNS), "").collect()}
        monkeypatch.undo()
        compared[n] = sum(counts)
        sets = [nearcopies.shingles(t.encode()) for t in texts]
        low = list(range(n))

        def head(i):
            while low[i] != i:
                low[i] = i = low[low[i]]
            return i

        for i in range(n):
            for j in range(i):
                if head(i) != head(j) and nearcopies.similarity(sets[i], sets[j]) >= nearcopies.SIMILAR:
                    low[max(head(i), head(j))] = min(head(i), head(j))
        assert kept == {i for i in range(n) if head(i) == i}
    # Pairs that are alike, but not enough, cost no texts; of the others only those close below the line are compared.
    assert compared[600] <= (600 if shape == "even" else 600 * 599 // 2 // 20), compared


def test_the_last_turn_makes_a_pair_once(spark, monkeypatch):
    """Texts that share several buckets and come close to the line without reaching it."""
    made, plain = [], type(spark.range(1)).distinct
    counted = lambda df: df.columns == ["a", "b"] and made.append((df.count(), plain(df).count()))
    monkeypatch.setattr(type(spark.range(1)), "distinct", lambda df: (counted(df), plain(df))[1])
    texts = alike(150, "mixed", random.Random(4))
    corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], COLUMNS), "").count()
    assert len(made) >= 3 and made[2][0] == made[2][1] > 0  # the third turn; what follows are components


def test_labels_are_components(spark):
    """Classes that only larger ones join have one label, too."""
    chain = [(k, 100 + k) for k in range(20)] + [(k, 101 + k) for k in range(19)]
    links = spark.createDataFrame([*chain, (500, 501), (501, 502), (502, 503), (503, 504), (504, 505), (505, 506)], "a long, b long").repartition(3)
    got = {r["cls"]: r["label"] for r in nearcopies._labels(links).collect()}
    assert got == {**dict.fromkeys([*range(20), *range(100, 120)], 0), **dict.fromkeys(range(500, 507), 500)}


def test_a_few_lead_a_large_group_before_all_are_compared(spark, monkeypatch):
    """Texts that their bucket's first does not join meet some of the others, not every member of every bucket."""
    made, plain = [], type(spark.range(1)).distinct
    monkeypatch.setattr(type(spark.range(1)), "distinct", lambda df: (df.columns == ["a", "b"] and made.append(df.count()), plain(df))[1])
    texts = alike(300, "mixed", random.Random(4))
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], COLUMNS), "").count()
    assert kept == 146 and len(made) >= 3 and made[1] < 40 * 300 and made[2] < 10 * 300, made
