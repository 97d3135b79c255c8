"""The source catalogue: one JSON document with ``sources`` and ``manual_sources``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.operators.health import source_key

CATALOGUE_SCHEMA = (
    "lookback_days int, limit_per_source int, source_failure_threshold int,"
    " include_unstable_sources boolean, feed_cache_retention_days int, weights map<string,double>,"
    " sources array<struct<name string, url string, category string, quality int, language string,"
    " tier int, failure_policy string, enabled boolean>>,"
    " manual_sources array<struct<name string, url string, category string, language string, reason string>>"
)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)


def enabled_sources(catalogue: DataFrame) -> DataFrame:
    """Sources that are not switched off, in catalogue order (``source_pos``), defaults filled."""
    listed = catalogue.select(F.posexplode("sources").alias("source_pos", "s"))
    return listed.filter(F.coalesce("s.enabled", F.lit(True))).select(
        source_key(F.col("s.name"), F.col("s.url")).alias("source_key"),
        "source_pos",
        F.col("s.name").alias("source_name"),
        F.col("s.url").alias("source_url"),
        F.col("s.category").alias("category"),
        F.coalesce("s.quality", F.lit(3)).alias("quality"),
        F.coalesce("s.language", F.lit("en")).alias("language"),
        F.coalesce("s.tier", F.lit(2)).alias("tier"),
        F.coalesce("s.failure_policy", F.lit("skip_when_unstable")).alias("failure_policy"),
    )


def manual_sources(catalogue: DataFrame) -> DataFrame:
    """The watch list that people read by hand; it never reaches a digest."""
    return catalogue.select(F.explode("manual_sources").alias("m")).select("m.*")
