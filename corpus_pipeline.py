"""Corpus pipeline: the stages in order, each over all that the one before kept.

Every stage but the last returns the columns of documents, with its decisions taken: toxic documents go, one document of
each near-duplicate group stays, repeated passages are cut out of the texts, personal data is replaced by its kind.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import packing, pii, simhash, suffix, toxicity
from marketloom.llm.common import aside, shared_folder, table, written


#: A repeated passage: at least so many bytes and words. 50 words of 240 bytes have 3.8 letters on average, so that the
#: bytes leave out hardly a passage of 50 words; repeated lines and notices of fewer words stay. Bytes of its first name.
PASSAGE_BYTES, PASSAGE_WORDS, PASSAGE_GRAM = 240, 50, 64
#: Words that a packing worker remembers: fewer than the query has, since the workers of earlier stages live on.
PACKING_MEMORY = 100_000


def _with_text(docs: DataFrame, found: DataFrame, column: str, back) -> DataFrame:
    """docs with the text that found has in column; n_chars, where there is one, follows the text."""
    out = back(found.withColumn("text", F.col(column)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


# What holds for all stages: a null text counts as empty and an empty one is a document like any other; texts are worked
# on whole, however long; equal rows are documents of their own; a null doc_id is kept; an empty table gives no rows; all
# other columns go through untouched, whatever their names.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. Without labels of both kinds the seed lexicon decides; an empty
    text has no votes and stays."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more. Empty and null texts
    are copies of each other, equal rows too; of rows that share a doc_id each is looked at by itself."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated passages of PASSAGE_WORDS words; a character that a cut leaves in part goes
    with it. A null text becomes empty; every copy of a passage goes, in equal rows as in others."""
    plain, back = aside(docs, "doc_id", "text")
    got = suffix.cut(plain, PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS)
    return _with_text(docs, got.withColumn("kept", suffix.as_text(F.col("kept"))), "kept", back)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; a null text stays null."""
    plain, back = aside(docs, "doc_id", "text")
    return _with_text(docs, pii.redact(plain), "clean_text", back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; every row gives one at least, since each ends with an id of its own."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), PACKING_MEMORY)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("suffix", cut_repeats), ("pii", redact), ("packing", pack)]
#: Learned scores, XXH64 fingerprints and a tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if k + 1 < len(STAGES) else docs
    return docs
