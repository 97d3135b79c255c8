"""From documents to token ids: quality, near-duplicates, personal data, mix, encoding.

Every stage takes the documents its predecessor kept and, but for the last, returns their columns. ``run``
writes each result to the shared folder before the next stage reads it.

Defined results: a null text counts as empty and stays null through the stages that pass texts on; rows that repeat are
near copies of each other, so one stays; a null id, language or source is a value of its own; columns beyond those of
documents are passed through by all stages but the last; an empty table gives an empty result, and so does a table
without usable labels give scores of one half, which pass. The key of the pseudonyms is the session's, see
``pii.session_key``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm import bpe, mixing, pii, quality_model, simhash
from feedloom.llm.common import read_documents, read_table
from feedloom.operators.stage import staged

RANKS = "byte_bpe_50k.tiktoken"


def _counted_anew(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that may have changed."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labels of these documents."""
    model = quality_model.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_model.with_scores(spark, docs, model, name="__quality")
    return scored.filter(F.col("__quality") >= quality_model.THRESHOLD).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, the document with the smallest id."""
    return simhash.one_of_each(docs, shingle_words=3, max_bits=3)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return _counted_anew(pii.with_pseudonyms(docs, pii.session_key(spark)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per epoch of every document that the mix takes."""
    return _counted_anew(mixing.mixed_documents(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its bytes."""
    return bpe.encode_documents(spark, docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("PII", without_personal_data),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

#: The classifier, the fingerprints and the tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
