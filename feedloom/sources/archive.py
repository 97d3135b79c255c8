"""The archive: every article of every written digest, in the order of ``line_no``.

A line's number is its digest date and its rank within that digest, so no run needs to read the archive to go
on numbering, and a digest that is written again replaces its own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.functions.dates import iso_text, record_date
from feedloom.functions.scoring import article_text, label_list
from feedloom.operators.ordering import ARCHIVE, article_seq
from feedloom.operators.segments import add_rank, top_rows
from feedloom.operators.stage import staged
from feedloom.settings import CHINA_RETAIL, DEFAULT_LEXICON, PRODUCT_SIGNALS, Lexicon
from feedloom.sources.tables import exists, read_state, update_state

ARCHIVE_SCHEMA = (
    "date string, title string, url string, source string, category string, score double,"
    " published_at string, line_no bigint"
)
_COLUMNS = ("date", "title", "url", "source", "category", "score", "published_at", "line_no")
_TAIL = ("node", "url", "line_no", "line")
TAIL_SCHEMA = f"node string, url string, line_no bigint, line struct<{ARCHIVE_SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>"
#: Lines of one digest date; more stop the job.
LINES_PER_DATE = 2**36


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archive rows from JSON lines; empty lines are skipped, a malformed line stops the job.

    No rows while there is no archive yet.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], ARCHIVE_SCHEMA)
    # The folders of a stored archive give a further column.
    return spark.read.schema(ARCHIVE_SCHEMA).option("mode", "FAILFAST").json(path).select(*_COLUMNS)


def archive_line(day: Column, rank: Column) -> Column:
    """Number of a line: its digest date, then its rank (1, 2, ...) there."""
    number = F.unix_date(day).cast("bigint") * F.lit(LINES_PER_DATE) + rank - 1
    return F.when(rank <= LINES_PER_DATE, number).otherwise(F.raise_error(F.lit("too many lines of a date")).cast("bigint"))


def archive_rows(scored: DataFrame) -> DataFrame:
    """Archive rows of scored articles; lines follow date and rank."""
    ranked = add_rank(
        scored.select("brief_date", "title", "url", "source_name", "category", "total", "published_at", "rank_total", "seq"),
        ["brief_date"], [F.desc("rank_total"), F.asc("seq")], "_line",
    )
    return ranked.select(
        F.date_format("brief_date", "yyyy-MM-dd").alias("date"), "title", "url",
        F.col("source_name").alias("source"), "category", F.col("total").alias("score"),
        iso_text(F.col("published_at")).alias("published_at"),
        archive_line(F.col("brief_date"), F.col("_line")).alias("line_no"),
    )


def append_archive(rows: DataFrame, path: str) -> None:
    """Add the lines of digest dates as JSON, one folder per date; nothing is deduplicated.

    The folder of a date is written as a whole, so a run that is repeated leaves each line once.
    """
    dated = rows.withColumn("brief_date", F.col("date")).hint("rebalance", "brief_date")
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("brief_date").json(path)


def append_with_tails(rows: DataFrame, path: str, tails: str, limit: int = 24) -> None:
    """``append_archive``, and the stored tails brought up to date by the new lines alone.

    Only the publication days of the new lines are touched. A date that is written again may take links away from
    its days, so then the tails are made from the archive anew; ``rows`` should be staged.
    """
    spark = rows.sparkSession
    dates = [r.date for r in rows.select("date").distinct().collect()]  # calendar dates
    again = any(exists(spark, f"{path}/brief_date={d}") for d in dates)
    append_archive(rows, path)
    if again or not exists(spark, tails):
        store_tails(day_tails(read_archive(spark, path), limit), tails, limit, whole=True)
    else:
        store_tails(day_tails(rows, limit), tails, limit)


def store_tails(new: DataFrame, tails: str, limit: int = 24, whole: bool = False) -> None:
    """Merge tails into the stored ones, or replace these as a ``whole``."""
    if whole:
        spark = new.sparkSession
        new = staged(new.select(*_TAIL), "tails")
        # Days that have no line any more are named too, so that their buckets are written.
        gone = read_state(spark, tails, TAIL_SCHEMA).join(new.select("node").distinct(), "node", "left_anti")
        marked = new.unionByName(gone.withColumn("line_no", F.lit(None).cast("bigint")).select(*_TAIL))
        update_state(staged(marked, "tails"), tails, TAIL_SCHEMA, lambda old, every: every.filter("line_no is not null"), key="node")
    else:
        update_state(staged(new.select(*_TAIL), "tails"), tails, TAIL_SCHEMA, lambda old, more: merged_tails(old, more, limit), key="node")


def read_tails(spark: SparkSession, path: str, tails: str, limit: int = 24) -> DataFrame:
    """The stored tails; from the archive itself where they aren't stored yet."""
    if exists(spark, tails) or not exists(spark, path):
        return read_state(spark, tails, TAIL_SCHEMA)
    return day_tails(read_archive(spark, path), limit).select(*_TAIL)


def line_place(line_no: Column) -> tuple[Column, Column]:
    """A line's place in ``seq``: days since 1970 (from 1970 on), and rank."""
    return F.floor(line_no / LINES_PER_DATE), F.pmod(line_no, F.lit(LINES_PER_DATE))


def _node(level: str, day: Column) -> Column:
    form = {"d": "yyyy-MM-dd", "m": "yyyy-MM", "y": "yyyy"}[level]
    return F.concat(F.lit(level), F.date_format(day, form))


def _newest(rows: DataFrame, by: list[str], limit: int) -> DataFrame:
    """Newest line of every link of a group, then the ``limit`` newest lines of the group, with their ``line``."""
    lines = rows.groupBy(*by, "url").agg(F.max("line_no").alias("line_no"), F.max_by("line", "line_no").alias("line"))
    return top_rows(lines, by, [F.desc("line_no")], limit, "_n").drop("_n")


def day_tails(archive: DataFrame, limit: int = 24, by: tuple[str, ...] = ()) -> DataFrame:
    """(node, url, line_no, line): the newest ``limit`` links of every publication day, ``none`` for lines without one.

    That is all the fallback needs of an archive: a link among the newest of a stretch of days is among the newest of
    its own day. ``by`` names further columns of ``archive`` that tell tails apart.
    """
    usable = archive.filter((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    day = F.to_date(record_date(F.col("published_at"), "archive date"))
    lines = usable.select(*by, "url", "line_no", F.struct(*_COLUMNS).alias("line"), F.coalesce(_node("d", day), F.lit("none")).alias("node"))
    return _newest(lines, [*by, "node"], limit)


def merged_tails(old: DataFrame, new: DataFrame, limit: int = 24) -> DataFrame:
    """Tails of two parts of an archive as those of both."""
    return _newest(old.select(*_TAIL).unionByName(new.select(*_TAIL)), ["node"], limit).select(*_TAIL)


def newest_for_dates(archive: DataFrame, dates: DataFrame, days: int, limit: int = 24) -> DataFrame:
    """``newest_of_tails`` of an archive; one pass over it."""
    return newest_of_tails(staged(day_tails(archive, limit), "archive-days"), dates, days, limit)


def newest_of_tails(by_day: DataFrame, dates: DataFrame, days: int, limit: int = 24) -> DataFrame:
    """(brief_date, archive columns): per date the newest ``limit`` distinct links published since its cutoff.

    The cutoff is ``days`` before the start of the date and there is no upper bound, so a date
    needs a whole tail of publication days. Each day, month and year is first reduced to its own
    newest ``limit`` links, which loses nothing. A date then reads the days to the end of the cutoff's month, the months
    to the end of that year, and the later years: equi-joins on a few dozen small nodes. Years after
    the next one of the last date are one node, so a wild publication date adds nothing.
    """
    last = dates.agg(F.max(F.year("brief_date")).alias("y")).first()["y"]
    if last is None:
        return by_day.limit(0).select(F.lit(None).cast("date").alias("brief_date"), "line.*")
    last += 1
    dated = by_day.filter("node <> 'none'").withColumn("day", F.substring("node", 2, 10).cast("date"))
    by_month = _newest(dated.withColumn("month", F.trunc("day", "month")), ["month"], limit)
    by_year = _newest(by_month.withColumn("year", F.least(F.year("month"), F.lit(last))), ["year"], limit)
    kept = ("url", "line_no", "line")
    nodes = (
        by_day.select("node", *kept)
        .unionByName(by_month.select(_node("m", F.col("month")).alias("node"), *kept))
        .unionByName(by_year.select(F.concat(F.lit("y"), F.col("year").cast("string")).alias("node"), *kept))
    )
    cut = F.date_sub("brief_date", days)
    year_end = F.make_date(F.year(cut), F.lit(12), F.lit(31))
    next_month = F.date_add(F.last_day(cut), 1)
    months = F.when(next_month <= year_end, F.sequence(next_month, year_end, F.expr("interval 1 month")))
    years = F.when(F.year(cut) < last, F.sequence(F.year(cut) + 1, F.lit(last)))
    cover = F.concat(
        F.array(F.lit("none")),
        F.transform(F.sequence(cut, F.last_day(cut)), lambda d: _node("d", d)),
        F.transform(F.coalesce(months, F.array().cast("array<date>")), lambda d: _node("m", d)),
        F.transform(F.coalesce(years, F.array().cast("array<int>")), lambda y: F.concat(F.lit("y"), y.cast("string"))),
    )
    asked = dates.select("brief_date").distinct().withColumn("node", F.explode(cover))
    return _newest(asked.join(nodes, "node"), ["brief_date"], limit).select("brief_date", "line.*")


def archived_articles(
    archive: DataFrame, sources: DataFrame, dates: DataFrame, days: int = 7, limit: int = 24,
    lexicon: Lexicon = DEFAULT_LEXICON,
) -> DataFrame:
    """Fallback articles of an archive, see ``articles_of_lines``."""
    return articles_of_lines(newest_for_dates(archive, dates, days, limit), sources, lexicon)


def articles_of_lines(picked: DataFrame, sources: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, skipped: DataFrame | None = None) -> DataFrame:
    """Fallback articles from picked archive lines with their stored total, in file order, per date.

    Sources are found by name (of equal names the last one counts), but for those ``skipped`` on the date; for an unknown
    name one is made up from the record. Components are fixed, keywords come from title, source and category.
    """
    attributes = F.struct("source_key", "source_url", "category", "quality", "language")
    if skipped is None:
        by_name = sources.groupBy(F.col("source_name").alias("source")).agg(F.max_by(attributes, "source_pos").alias("s"))
        rows = picked.join(by_name, "source", "left")
    else:
        asked = picked.select("brief_date", "source").distinct()
        named = sources.select(F.col("source_name").alias("source"), "source_key", "source_pos", attributes.alias("_s"))
        read = asked.join(named, "source").join(skipped, ["brief_date", "source_key"], "left_anti")
        by_name = read.groupBy("brief_date", "source").agg(F.max_by("_s", "source_pos").alias("s"))
        rows = picked.join(by_name, ["brief_date", "source"], "left")
    known = F.col("s").isNotNull()
    category = F.coalesce("category", F.lit(PRODUCT_SIGNALS))
    made_up = F.when(F.col("category") == CHINA_RETAIL, "zh").otherwise("en")
    total = F.round(F.coalesce("score", F.lit(3.0)), 2)
    named = rows.select(
        "brief_date", article_seq(ARCHIVE, *line_place(F.col("line_no"))), "title", "url",
        F.coalesce("source", F.lit("Archive")).alias("source_name"),
        F.when(known, F.col("s.source_url")).otherwise(F.col("url")).alias("source_url"),
        F.when(known, F.col("s.category")).otherwise(category).alias("category"),
        F.when(known, F.col("s.quality")).otherwise(4).alias("quality"),
        F.when(known, F.col("s.language")).otherwise(made_up).alias("language"),
        record_date(F.col("published_at"), "archive date").alias("published_at"),
        total.alias("total"),
    )
    text = article_text(F.col("title"), F.lit(""), F.col("source_name"), F.col("category"))
    return named.withColumns(
        {
            "impact": F.lit(3), "novelty": F.lit(3), "source_quality": F.col("quality"),
            "pm_relevance": F.lit(3), "actionability": F.lit(3),
            "keywords": label_list(text, F.col("category"), lexicon),
            "summary": F.lit(""),
        }
    )
