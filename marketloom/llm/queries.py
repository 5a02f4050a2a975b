"""The queries of this folder, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers

from . import codes, crosstokens, graphdedup, lmscore, oneperm, packing, pieces, pii, simhash, suffix, tokencount, topk, toxicity
from .common import table


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents")).drop("clean_text")


def op4_sentencepiece(spark, sf_dir):
    got = pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op6_lm_scoring(spark, sf_dir):
    return lmscore.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A passage of op7's further columns: bytes, bytes of its first name, words.
PASSAGE = (240, 64, 50)


def op7_suffix(spark, sf_dir):
    got = suffix.cut(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=PASSAGE)
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_bytes")


def op8_token_counts(spark, sf_dir):
    return tokencount.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_embedding_dedup(spark, sf_dir):
    return graphdedup.near_duplicates(table(spark, sf_dir, "embeddings")).drop("audited_recall")


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), memory=300_000)


def op11_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark, sf_dir):
    return oneperm.fingerprints(table(spark, sf_dir, "documents"))


def op13_cross_tokens(spark, sf_dir):
    return crosstokens.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_toxicity, op3_pii, op4_sentencepiece, op5_top_k, op6_lm_scoring, op7_suffix, op8_token_counts, op9_embedding_dedup, op10_packing,
        op11_vector_codes, op12_fingerprints, op13_cross_tokens,
    )
}


def _codes_sql(rounds: int = 6) -> str:
    """op11's contract: a table of nearest entries and one of codebooks for each round. a: part position, e: entry."""
    square = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"d{k} AS MATERIALIZED (SELECT vec_id, label, a, e, x, {square} AS d FROM v JOIN b{k} USING (a)), n{k} AS MATERIALIZED (SELECT vec_id, label, a, min(d) AS d, arg_min(e, (d, e)) AS e, any_value(x) AS x FROM d{k} GROUP BY ALL)".replace("GROUP BY ALL", "GROUP BY vec_id, label, a"))
        if k < rounds:
            steps.append(
                f"s{k} AS (SELECT a, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM n{k}, range(1, 9) t(i) GROUP BY a, e, i), "
                f"b{k + 1} AS MATERIALIZED (SELECT a, e, coalesce(g.c, b.c) AS c FROM b{k} b LEFT JOIN (SELECT a, e, list(m ORDER BY i) AS c FROM s{k} GROUP BY a, e) g USING (a, e))"
            )
    last = rounds
    return f"""
        WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS y FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT vec_id, label, a, y[a * 8 + 1 : a * 8 + 8] AS x FROM k, range(8) t(a)),
        b0 AS MATERIALIZED (SELECT a, e, x AS c FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (vec_id) WHERE e < 16),
        {", ".join(steps)},
        r AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY a) AS code, CAST(sum(d) AS BIGINT) AS error FROM n{last} GROUP BY vec_id, label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY a, e)) FROM b{last}) AS codebooks_sha256 FROM r
    """


#: Joins and aggregates over brute force; of the other queries SQL can't express the tokenizers, learned scores or hashes.
ORACLES = {
    "op11_vector_codes": _codes_sql(),
    "op5_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op9_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
        r AS (SELECT vec_id AS a, vec_id AS low FROM v UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.a WHERE r.low < l.b),
        c AS (SELECT a AS vec_id, min(low) AS component_id FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id
    """,
}
