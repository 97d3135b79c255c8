"""The jobs as Structured Streaming: the same operators, fed by micro-batches.

Each job takes a stream, an output folder and a checkpoint folder, works off what is there
(``availableNow``) and stops; run it again for what has come since. A batch writes a folder or a
state version named by its number, so a batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedloom.functions.urls import with_url_key
from feedloom.operators.health import HEALTH_SCHEMA, closed_runs
from feedloom.operators.stage import staged, staged_counted
from feedloom.plans.validate import fold_into_table
from feedloom.sources.cache import CACHE_SCHEMA, upsert_cache
from feedloom.sources.feeds import feed_articles, read_feeds
from feedloom.sources.tables import read_or_empty, read_state, update_state

_BATCH = "batch"
_COUNTS = "n bigint, n_accepted bigint, n_late bigint, newest timestamp, batch bigint"


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    _finish(stream.writeStream.outputMode(mode).foreachBatch(work), checkpoint)


def ingest_feeds(payloads: DataFrame, sources: DataFrame, out: str, checkpoint: str, limit: int = 8) -> None:
    """Parse landed payloads as they come; one folder of articles per batch."""

    def parse(batch: DataFrame, number: int) -> None:
        articles = feed_articles(read_feeds(batch, limit), sources)
        articles.write.mode("overwrite").parquet(f"{out}/{_BATCH}={number}")

    _each_batch(payloads, parse, checkpoint)


def update_health(
    checks: DataFrame, out: str, checkpoint: str, threshold: int = 3, lateness: str = "1 hour", history: str | None = None
) -> None:
    """Keep source health current, run by run: a run counts once it is whole, see ``closed_runs``.

    Runs are folded in the order they close. A batch rewrites the state of the sources it checked only, and a batch
    that closes no run writes nothing.
    """

    def fold(batch: DataFrame, number: int) -> None:
        fold_into_table(batch, out, threshold, number, history)

    _each_batch(closed_runs(checks, lateness), fold, checkpoint)


def update_cache(live: DataFrame, out: str, checkpoint: str, retention_days: int = 7) -> None:
    """Keep the feed cache current; ``live`` carries ``fetched_at``. A batch rewrites the entries' buckets only."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return upsert_cache(old, new, F.col("fetched_at"), retention_days)

    def update(batch: DataFrame, number: int) -> None:
        rows, n = staged_counted(batch, "live")
        if n > 0:
            update_state(rows, out, CACHE_SCHEMA, merge, number)

    _each_batch(live, update, checkpoint)


def count_days(events: DataFrame, time: str, by: list[str], out: str, checkpoint: str, lateness: str = "3 days") -> None:
    """Daily counts per ``by``; rows later than ``lateness`` are dropped and old days leave the state.

    A batch writes the counts it changed; ``read_day_counts`` takes the newest of each.
    """
    counts = (
        events.withWatermark(time, lateness)
        .groupBy(F.window(time, "1 day"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("window.start").alias("day"), *by, "n")
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{_BATCH}={number}")

    _each_batch(counts, write, checkpoint, "update")


def read_day_counts(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    return spark.read.parquet(out).groupBy("day", *by).agg(F.max_by("n", _BATCH).alias("n"))


def drop_seen_links(articles: DataFrame, out: str, checkpoint: str, retention: str = "7 days") -> None:
    """Drop articles whose link came before within the retention; one of several copies stays, whichever comes first.

    The links seen are kept in the state store and leave it when the watermark passes their time and the retention, so
    state is bounded by the links of that span, and nothing that was written is read again. An article without a date
    takes the time it was fetched; without that either it would stay in the state for good, so it goes round it and is
    kept. Articles behind the watermark are dropped. Weaker than the digest's own duplicate removal, which still runs
    per date.
    """
    timed = with_url_key(articles.withColumn("event_time", F.coalesce("published_at", "fetched_at")))
    fresh = timed.filter("event_time is not null").withWatermark("event_time", retention).dropDuplicatesWithinWatermark(["link_key"])

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{_BATCH}={number}")

    _each_batch(fresh.unionByName(timed.filter("event_time is null")), write, checkpoint)


def split_late(events: DataFrame, time: str, out: str, checkpoint: str, lateness: str = "3 days") -> None:
    """Part a stream into rows in time and rows too late, so that no row goes missing unseen.

    Late is what a watermark of ``lateness`` would drop: a row older than the newest time of all *earlier* batches less
    ``lateness``. Rows in time go to ``out/accepted``, late ones and those without a time to ``out/late`` with their
    ``reason``; ``out/counts`` has a row per batch with the numbers, observed while the rows are written. A
    batch reads the counts of the last one for its bound, and no rows of earlier batches.
    """

    def part(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = read_or_empty(spark, f"{out}/counts", _COUNTS).filter(F.col(_BATCH) < number).agg(F.max("newest")).first()[0]
        edge = F.lit(before).cast("timestamp") - F.expr(f"interval {lateness}")
        at = F.col(time).cast("timestamp")
        reason = F.when(at.isNull(), "no time").when(at < edge, "late")
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason").isNull()).alias("n_accepted"), F.count_if(F.col("reason") == "late").alias("n_late")]
        # The newest time of all batches so far, so that the last row of counts is all a batch needs.
        newest = F.greatest(F.max(at), F.lit(before).cast("timestamp")).alias("newest")
        marked = batch.withColumn("reason", reason).observe(seen, *counts, newest)
        rows = staged(marked, "events")
        rows.filter("reason is null").drop("reason").write.mode("overwrite").parquet(f"{out}/accepted/{_BATCH}={number}")
        rows.filter("reason is not null").write.mode("overwrite").parquet(f"{out}/late/{_BATCH}={number}")
        ledger = spark.createDataFrame([tuple(seen.get[c] for c in ("n", "n_accepted", "n_late", "newest"))], "n bigint, n_accepted bigint, n_late bigint, newest timestamp")
        ledger.write.mode("overwrite").parquet(f"{out}/counts/{_BATCH}={number}")

    _each_batch(events, part, checkpoint)


def read_health(spark: SparkSession, out: str) -> DataFrame:
    return read_state(spark, out, HEALTH_SCHEMA)


def read_cache(spark: SparkSession, out: str) -> DataFrame:
    return read_state(spark, out, CACHE_SCHEMA)
