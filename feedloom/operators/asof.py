"""Looking up the newest earlier digest, and the dates still to do."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F

from feedloom.operators.segments import cut_segments


def prior_report_dates(dates: DataFrame, report_dates: DataFrame) -> DataFrame:
    """(brief_date, prior_date): newest report strictly before each date, null when there is none.

    Both sides hold one row per calendar date. The search runs per year; only one row per year is
    ordered across years, so no task sees more than a year of dates or ten thousand years.
    """
    asked = dates.select("brief_date", F.lit(None).cast("date").alias("report_date")).distinct()
    known = report_dates.select(F.col("report_date").alias("brief_date"), "report_date").distinct()
    both = asked.unionByName(known).withColumn("_year", F.year("brief_date"))
    # Rows of the same date: the question comes before the report, which makes the search strict.
    in_year = (
        Window.partitionBy("_year")
        .orderBy("brief_date", F.col("report_date").isNotNull())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = both.withColumn("_in_year", F.last("report_date", ignorenulls=True).over(in_year))
    years = both.groupBy("_year").agg(F.max("report_date").alias("_newest"))
    # One row per year: an unpartitioned window over at most ten thousand rows.
    earlier = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    carried = years.select("_year", F.last("_newest", ignorenulls=True).over(earlier).alias("_carried"))
    return (
        found.filter(F.col("report_date").isNull())
        .join(carried, "_year")
        .select("brief_date", F.coalesce("_in_year", "_carried").alias("prior_date"))
    )


def latest_known(asked: DataFrame, known: DataFrame, by: list[str], time: str, tie: str, columns: list[str]) -> DataFrame:
    """``asked`` with the ``columns`` of the newest row of ``known`` of the same ``by`` at or before its ``time``.

    Of rows at the same time the one with the greatest ``tie`` counts; without any the columns are null. Both sides are
    put in one order and cut into segments, so a key with a very long history spans many tasks; a segment hands its
    last known row on to the next ones.
    """
    marked = known.filter(F.col(time).isNotNull()).select(*by, time, F.col(tie).alias("_tie"), F.struct(*columns).alias("_known"), F.lit(0).alias("_asks"))
    rest = [c for c in asked.columns if c not in (*by, time)]
    questions = asked.select(*by, time, F.struct(F.lit(True).alias("_is"), *rest).alias("_question"), F.lit(1).alias("_asks"))
    both = marked.unionByName(questions, allowMissingColumns=True)
    # At the same time the known rows come first.
    order = [time, "_asks", "_tie"]
    cut = cut_segments(both, by, order)
    keys = [*by, "segment"]
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_found", F.last("_known", ignorenulls=True).over(so_far))
    ends = cut.filter("_asks = 0").groupBy(*keys).agg(F.max_by("_known", F.struct(time, "_tie")).alias("_end"))
    every = cut.select(*keys).distinct().join(ends, keys, "left")
    before = Window.partitionBy(*by).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    handed = every.select(*keys, F.last("_end", ignorenulls=True).over(before).alias("_handed"))
    answered = local.filter("_asks = 1").join(handed, keys)
    found = F.coalesce("_found", "_handed")
    names = [F.col(f"_question.{c}").alias(c) for c in rest]
    return answered.select(*by, time, *names, *(found[c].alias(c) for c in columns))


def pending_dates(dates: DataFrame, published: DataFrame) -> DataFrame:
    """Dates that no published document covers yet."""
    return dates.join(published.select("brief_date").distinct(), "brief_date", "left_anti")


def published_dates(documents: DataFrame, title: str) -> DataFrame:
    """Dates whose heading line stands in a published document (column ``text``)."""
    heading = rf"(?m)^# {re.escape(title)} — (\d{{4}}-\d{{2}}-\d{{2}})$"
    found = documents.select(F.explode(F.regexp_extract_all("text", F.lit(heading), F.lit(1))).alias("day"))
    return found.select(F.col("day").try_cast("date").alias("brief_date")).filter("brief_date is not null").distinct()
