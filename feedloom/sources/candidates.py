"""Hand-supplied candidates: JSON arrays, in files that are, or whose folder is, named by the date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.functions.dates import record_date
from feedloom.operators.health import source_key
from feedloom.operators.ordering import CANDIDATE, article_seq

CANDIDATE_SCHEMA = (
    "title string, url string, source string, source_url string, category string, quality int,"
    " language string, published_at string, summary string"
)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Raw candidate rows with ``brief_date`` from the path and ``item_pos`` from the order in the file.

    Each file is read as one text, because the position in the array counts and a file is a
    person's work of one day.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_name"),
        F.from_json("value", f"array<struct<{_struct(CANDIDATE_SCHEMA)}>>", {"mode": "FAILFAST"}).alias("_items"),
    )
    day = F.regexp_extract("_name", r".*(\d{4}-\d{2}-\d{2})", 1).cast("date")
    return files.select(day.alias("brief_date"), F.posexplode("_items").alias("item_pos", "c")).select(
        "brief_date", "item_pos", "c.*"
    )


def _struct(ddl: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (part.split() for part in ddl.split(",")))


def _required(name: str) -> Column:
    return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"candidate without {name}"))).otherwise(F.col(name))


def candidate_articles(raw: DataFrame) -> DataFrame:
    """Candidates as article rows; a missing title, url, source or category stops the job."""
    filled = raw.select(
        "brief_date", "item_pos",
        _required("title").alias("title"), _required("url").alias("url"),
        F.coalesce("summary", F.lit("")).alias("summary"),
        record_date(F.col("published_at"), "candidate date").alias("published_at"),
        _required("source").alias("source_name"), F.coalesce("source_url", "url").alias("source_url"),
        _required("category").alias("category"),
        F.coalesce("quality", F.lit(4)).alias("quality"), F.coalesce("language", F.lit("en")).alias("language"),
    )
    return filled.withColumns(
        {
            "source_key": source_key(F.col("source_name"), F.col("source_url")),
            "seq": article_seq(CANDIDATE, F.lit(0), F.col("item_pos")),
        }
    ).drop("item_pos")
