"""The feed cache: the last good articles of every source.

Stored flat, one row per cached article, so that no source is ever gathered into one value. A
source whose delivered articles are all too old still has an entry: one row without an article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.dates import day_end, minus_days
from feedloom.operators.ordering import CACHE, article_seq, item_position

CACHE_SCHEMA = (
    "source_key string, source_name string, source_url string, category string, quality int,"
    " language string, fetched_at timestamp, item_pos bigint, title string, url string,"
    " published_at timestamp, summary string"
)
_ENTRY = ("source_key", "source_name", "source_url", "category", "quality", "language", "fetched_at")
_ARTICLE = {"item_pos": "bigint", "title": "string", "url": "string", "published_at": "timestamp", "summary": "string"}


def cache_rows(live: DataFrame, fetched_at: Column, retention_days: int = 7, run: tuple[str, ...] = ()) -> DataFrame:
    """Cache rows of delivered articles; articles past the retention are left out, null dates stay.

    ``run`` names further columns that tell runs apart.
    """
    stamped = live.withColumns(
        {"fetched_at": fetched_at, "item_pos": item_position(F.col("seq"))}
    )
    edge = minus_days(F.col("fetched_at"), retention_days)
    young = F.col("published_at").isNull() | (F.col("published_at") >= edge)
    entry = [*run, *_ENTRY]
    articles = stamped.filter(young).select(*entry, *_ARTICLE)
    # One row without an article for a run, whatever its articles say of their source.
    keys = [*run, "source_key", "fetched_at"]
    others = F.min(F.struct(*[c for c in entry if c not in keys])).alias("_entry")
    outdated = stamped.filter(~young).groupBy(*keys).agg(others).select(*keys, "_entry.*")
    empty = outdated.select(*entry, *[F.lit(None).cast(kind).alias(name) for name, kind in _ARTICLE.items()])
    return articles.unionByName(empty)


def upsert_cache(cache: DataFrame, live: DataFrame, fetched_at: Column, retention_days: int = 7) -> DataFrame:
    """New cache: entries of sources with live articles replaced as a whole, all others kept.

    ``live`` may hold several runs; each source's newest one makes its entry, so a source has one. A run older
    than the entry that is there changes nothing.
    """
    stamped = live.withColumn("_at", fetched_at)
    known = cache.groupBy("source_key").agg(F.max("fetched_at").alias("_known"))
    newest = stamped.groupBy("source_key").agg(F.max("_at").alias("_at")).join(known, "source_key", "left")
    newest = newest.filter(F.col("_known").isNull() | (F.col("_at") >= F.col("_known"))).drop("_known")
    delivered = stamped.join(newest, ["source_key", "_at"], "left_semi").drop("_at")
    kept = cache.join(newest, "source_key", "left_anti")
    return kept.unionByName(cache_rows(delivered, fetched_at, retention_days))


def cached_articles(cache: DataFrame, sources: DataFrame) -> DataFrame:
    """Cached articles with the source's *current* attributes; they need a title and a link."""
    valid = cache.filter((F.col("title") != "") & (F.col("url") != ""))
    own = ("item_pos", "title", "url", "summary", "published_at", "fetched_at")
    kept = [c for c in valid.columns if c not in (*_ENTRY, *own)]
    rows = valid.select(*kept, "source_key", *own).withColumn("summary", F.coalesce("summary", F.lit("")))
    joined = rows.join(sources, "source_key")
    return joined.withColumn("seq", article_seq(CACHE, F.col("source_pos"), F.col("item_pos")))


def serve_cache(
    articles: DataFrame, cache: DataFrame, dates: DataFrame, max_age_days: int = 7, skipped: DataFrame | None = None
) -> DataFrame:
    """Cached articles for each date, the way a run on that date would find them.

    Cache rows carry the ``run_date`` that wrote them. Runs follow each other, so a date sees the
    newest entry of each source up to that date, and uses it while it is not past its age. An entry
    can serve only the few dates within that age, so just (source, run) pairs are copied to dates;
    ``articles`` may already be scored and cut to short rows. ``skipped`` sources (brief_date, source_key) serve nothing.
    """
    serves = F.explode(F.sequence(F.col("run_date"), F.date_add("run_date", max_age_days)))
    newest = (
        cache.select("source_key", "run_date").distinct().withColumn("brief_date", serves)
        .join(F.broadcast(dates.select("brief_date").distinct()), "brief_date", "left_semi")
        .groupBy("brief_date", "source_key")
        .agg(F.max("run_date").alias("run_date"))
    )
    if skipped is not None:
        newest = newest.join(skipped, ["brief_date", "source_key"], "left_anti")
    served = articles.join(newest, ["source_key", "run_date"])
    return served.filter(F.col("fetched_at") >= minus_days(day_end(F.col("brief_date")), max_age_days))


def rows_in_reach(cache: DataFrame, dates: DataFrame, max_age_days: int = 7) -> DataFrame:
    """Cache rows of the runs that can serve one of the dates at all."""
    runs = F.explode(F.sequence(F.date_sub("brief_date", max_age_days), F.col("brief_date")))
    needed = dates.select(runs.alias("run_date")).distinct()
    # Calendar dates: always few enough to broadcast.
    return cache.join(F.broadcast(needed), "run_date", "left_semi")
