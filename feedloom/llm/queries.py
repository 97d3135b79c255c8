"""The queries of this package: each applies its operator to a whole table and derives the result columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from corpus_pipeline import run
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm import bpe, fertility, hard_negatives, kd_shards, licences, minhash_forest, mixing, pii, quality_model, secrets, simhash, weighted_sampling, whitening
from feedloom.llm.common import read_documents, read_table
from feedloom.llm.sql import llm_sql  # noqa: F401  for the entry points

BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
SHARDS = 16


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 leaves of near equal bytes."""
    placed = kd_shards.kd_shards(read_documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document. A source is an owner, each of its languages a repository."""
    owner = F.coalesce(F.col("source"), F.lit(""))
    repository = F.concat_ws("/", owner, F.coalesce(F.col("lang"), F.lit("")))
    found = secrets.secret_spans(read_documents(spark, sf_dir), owner, repository)
    return found.select("doc_id", *secrets.span_columns(), "n_live", "n_copied", "max_owners", "max_repositories")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_documents(spark, sf_dir), shingle_words=3, max_bits=3)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.taken_words(*mixing.mix_plan(read_documents(spark, sf_dir))).drop("source")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of phrases, labels and score of every document."""
    found = licences.scan_documents(spark, read_documents(spark, sf_dir))
    starts, base = F.transform("base", lambda b: b["start"]), F.transform("base", lambda b: b["label"])
    every = F.concat(base, F.transform("matches", lambda m: m["label"]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(every).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text under pseudonyms, with what was found where in the old one."""
    found = pii.with_pseudonyms(read_documents(spark, sf_dir), pii.session_key(spark), found="found")
    return found.select("doc_id", "text", *pii.counts_and_spans(F.col("found")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return bpe.encode_documents(
        spark, read_documents(spark, sf_dir), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, digests=True
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model that learned from the labels outside the held-out fold."""
    docs = read_documents(spark, sf_dir)
    model = quality_model.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_model.with_scores(spark, docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality_model.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, measures and verdict of every document."""
    rows = fertility.measure_documents(
        spark, read_documents(spark, sf_dir), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, public_tokenizers.path(PIECE_MODEL)
    )
    return fertility.verdicts(rows).select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        *("n_tokens", "byte_chars", "piece_chars", "fallback", "entropy", "band_failed"),
    )


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return weighted_sampling.fingerprints(read_documents(spark, sf_dir))


def op11_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    return minhash_forest.near_duplicates(read_documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, searched among all."""
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every remaining embedding on the first components of the fit list."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_kd_shards": op1_kd_shards,
        "op2_secrets": op2_secrets,
        "op3_simhash": op3_simhash,
        "op4_mixing": op4_mixing,
        "op5_licences": op5_licences,
        "op6_pii": op6_pii,
        "op7_bpe": op7_bpe,
        "op8_quality": op8_quality,
        "op9_fertility": op9_fertility,
        "op10_weighted_sampling": op10_weighted_sampling,
        "op11_minhash_forest": op11_minhash_forest,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_whitening": op13_whitening,
        "pipeline": run,
    }

