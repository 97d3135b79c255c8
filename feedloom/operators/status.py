"""Run status per digest date, and the checks built on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.settings import AI_FRONTIER, AI_VIDEO, CATEGORIES, CHINA_RETAIL, MARKETPLACE, Gate, Quota

STATUS_SCHEMA = (
    "brief_date date, output_path string, source_count int, configured_source_count int, skipped_source_count int,"
    " fetched_article_count bigint, candidate_article_count bigint, candidate_count bigint, scored_count bigint,"
    " must_read_count bigint, ai_watch_count bigint, marketplace_count bigint, live_article_count bigint,"
    " failed_sources array<string>, preserved_existing boolean, fallback_mode string"
)


def tally(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per date of several tables, one count column each, in a single aggregation."""
    named = [table.select("brief_date", F.lit(name).alias("_of")) for name, table in tables.items()]
    rows = reduce(DataFrame.unionByName, named)
    return rows.groupBy("brief_date").agg(*[F.count_if(F.col("_of") == name).alias(name) for name in tables])


def section_counts(items: DataFrame) -> DataFrame:
    """must_read_count, ai_watch_count and marketplace_count per date."""
    sections = ("must_read", "ai_watch", "marketplace")
    return items.groupBy("brief_date").agg(
        *[F.count_if(F.col("section") == s).alias(f"{s}_count") for s in sections]
    )


def failed_sources(failures: DataFrame) -> DataFrame:
    """Names of the sources that failed on a date, in catalogue order."""
    listed = F.array_sort(F.collect_list(F.struct("source_pos", "source_name"))).getField("source_name")
    return failures.groupBy("brief_date").agg(listed.alias("failed_sources"))


def by_date(dates: DataFrame, *parts: DataFrame) -> DataFrame:
    """Per-date results joined to ``dates``, counts 0 where a part has no row for a date."""
    result = dates
    for part in parts:
        result = result.join(part, "brief_date", "left")
    counts = [f.name for f in result.schema.fields if f.name.endswith("_count") or f.name.startswith("n_")]
    return result.fillna(0, subset=counts)


def quality_gate(status: DataFrame, gate: Gate = Gate()) -> DataFrame:
    """``reasons`` why a run may not be published, and ``sufficient`` when there are none."""
    fresh = F.col("candidate_article_count") + F.col("live_article_count")
    rules: dict[str, Column] = {
        "preserved": F.col("preserved_existing"),
        "candidates": F.col("candidate_count") < gate.min_candidates,
        "fresh_articles": fresh < gate.min_fresh,
        "must_reads": F.col("must_read_count") < gate.min_must_read,
        "ai_watch": F.col("ai_watch_count") < gate.min_ai_watch,
        "marketplace": F.col("marketplace_count") < gate.min_marketplace,
    }
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return status.withColumn("reasons", reasons).withColumn("sufficient", F.size("reasons") == 0)


def candidate_quota(candidates: DataFrame, quota: Quota = Quota()) -> DataFrame:
    """Per date: candidates by kind, categories that are not known, and whether the targets are met."""
    category = F.col("category")
    counted = candidates.groupBy("brief_date").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(category.isin(AI_FRONTIER, AI_VIDEO)).alias("n_ai"),
        F.count_if(category == MARKETPLACE).alias("n_marketplace"),
        F.count_if(category == CHINA_RETAIL).alias("n_china"),
        F.count_if(~category.isin(*CATEGORIES)).alias("n_unknown_category"),
    )
    met = (
        F.col("n_items").between(quota.min_items, quota.max_items)
        & (F.col("n_ai") >= quota.min_ai)
        & (F.col("n_marketplace") >= quota.min_marketplace)
        & (F.col("n_china") >= quota.min_china)
        & (F.col("n_unknown_category") == 0)
    )
    return counted.withColumn("meets_quota", met)


def unknown_categories(candidates: DataFrame) -> DataFrame:
    """Candidates whose category is not one of the known ones."""
    known = candidates.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return candidates.join(F.broadcast(known), "category", "left_anti")


def status_text(status: DataFrame) -> DataFrame:
    """(brief_date, text): the status of each date as a list for people."""
    failed = F.when(F.size("failed_sources") > 0, F.array_join("failed_sources", ", ")).otherwise("None")
    rows = {
        "Brief date": F.date_format("brief_date", "yyyy-MM-dd"),
        "Output path": F.col("output_path"),
        "Source count": F.col("source_count"),
        "Configured source count": F.col("configured_source_count"),
        "Skipped unstable source count": F.col("skipped_source_count"),
        "Fetched article count": F.col("fetched_article_count"),
        "Candidate article count": F.col("candidate_article_count"),
        "Candidate count": F.col("candidate_count"),
        "Scored count": F.col("scored_count"),
        "Must Read count": F.col("must_read_count"),
        "AI Product Watch count": F.col("ai_watch_count"),
        "Marketplace count": F.col("marketplace_count"),
        "Live article count": F.col("live_article_count"),
        "Preserved existing report": F.initcap(F.col("preserved_existing").cast("string")),
        "Fallback mode": F.col("fallback_mode"),
        "Failed sources": failed,
    }
    lines = [F.concat(F.lit(f"- {name}: "), F.coalesce(value.cast("string"), F.lit(""))) for name, value in rows.items()]
    return status.select("brief_date", F.concat_ws("\n", *lines).alias("text"))
