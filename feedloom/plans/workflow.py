"""The whole daily job over stored tables: payloads in, digests, status, archive and cache out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom import wording
from feedloom.operators.asof import pending_dates
from feedloom.operators.health import HEALTH_SCHEMA, skipped_sources, state_as_history
from feedloom.operators.stage import scratch, staged
from feedloom.operators.status import STATUS_SCHEMA
from feedloom.plans.daily import DigestInputs, DigestRun
from feedloom.plans.validate import read_history
from feedloom.settings import RunSettings, Weights
from feedloom.sources.archive import append_with_tails, day_tails, read_archive, read_tails
from feedloom.sources.cache import CACHE_SCHEMA, cache_rows, upsert_cache
from feedloom.sources.candidates import candidate_articles
from feedloom.sources.catalogue import enabled_sources
from feedloom.sources.feeds import feed_articles, feed_failures, newest_payloads, read_feeds
from feedloom.sources.tables import read_or_empty, read_state, update_state, write_dates


@dataclass(frozen=True)
class Folders:
    """Where a deployment keeps its tables; any file system Spark reads."""

    root: str

    @property
    def health(self) -> str:
        return f"{self.root}/health"

    @property
    def health_history(self) -> str:
        return f"{self.root}/health_history"

    @property
    def cache(self) -> str:
        return f"{self.root}/cache"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def archive_tails(self) -> str:
        return f"{self.root}/archive_tails"

    @property
    def documents(self) -> str:
        return f"{self.root}/documents"

    @property
    def status(self) -> str:
        return f"{self.root}/status"


def settings_of(catalogue: DataFrame, base: RunSettings = RunSettings()) -> RunSettings:
    """Run settings with the values the catalogue document gives (one row of options)."""
    given = catalogue.drop("sources", "manual_sources").first().asDict()
    names = {
        "lookback_days": "lookback_days",
        "limit_per_source": "items_per_source",
        "source_failure_threshold": "failure_threshold",
        "feed_cache_retention_days": "cache_retention_days",
        "include_unstable_sources": "include_unstable",
    }
    found = {own: given[name] for name, own in names.items() if given[name] is not None}
    return replace(base, **found, weights=Weights.from_config(given["weights"]))


def run_digests(
    spark: SparkSession,
    catalogue: DataFrame,
    payloads: DataFrame,
    candidates: DataFrame,
    dates: DataFrame,
    folders: Folders,
    as_of: Column,
    title: str = wording.DEFAULT_TITLE,
) -> DataFrame:
    """Run all ``dates`` that have no digest yet, store the results, and return the stored status of all dates.

    ``payloads`` and raw ``candidates`` carry the date they were fetched or written for;
    ``as_of`` is the time against which source health is judged; it may use ``brief_date``, and every date is judged by
    the history up to its own time (where only the state is kept: by the state). Intermediate tables are removed at the end.
    A run that broke off is simply run again: what it wrote is replaced.
    """
    with scratch(spark):
        _run(spark, catalogue, payloads, candidates, dates, folders, as_of, title)
    return read_or_empty(spark, folders.status, STATUS_SCHEMA)


def _tails_before(spark: SparkSession, folders: Folders, todo: DataFrame, limit: int) -> DataFrame:
    """The archive's tails without lines that an earlier try left for the dates to do; these are about to be replaced."""
    tails = staged(read_tails(spark, folders.archive, folders.archive_tails, limit), "tails")
    again = F.broadcast(todo.select(F.date_format("brief_date", "yyyy-MM-dd").alias("date")))
    if tails.join(again, tails["line.date"] == again["date"], "left_semi").isEmpty():
        return tails
    kept = read_archive(spark, folders.archive).join(again, "date", "left_anti")
    return staged(day_tails(kept, limit), "tails")


def _run(
    spark: SparkSession, catalogue: DataFrame, payloads: DataFrame, candidates: DataFrame, dates: DataFrame,
    folders: Folders, as_of: Column, title: str,
) -> None:
    settings = settings_of(catalogue)
    configured = enabled_sources(catalogue)
    history = read_history(spark, folders.health_history)
    state = state_as_history(read_state(spark, folders.health, HEALTH_SCHEMA))
    known = history.unionByName(state.join(history.select("source_key").distinct(), "source_key", "left_anti"))

    reports = read_or_empty(spark, folders.documents, "document string, brief_date date").select("brief_date")
    todo = staged(pending_dates(dates.select("brief_date").distinct(), reports), "todo")
    skipped = staged(skipped_sources(configured, known, todo, as_of, settings.include_unstable, settings.success_grace_days), "skipped")
    asked = payloads.join(F.broadcast(todo), "brief_date", "left_semi").join(configured.select("source_key"), "source_key", "left_semi")
    wanted = newest_payloads(asked.join(skipped, ["brief_date", "source_key"], "left_anti"))
    feeds = staged(read_feeds(wanted, settings.items_per_source), "feeds")
    live = staged(feed_articles(feeds, configured), "live")

    stored = staged(read_state(spark, folders.cache, CACHE_SCHEMA), "cache")
    cached = stored.withColumn("run_date", F.to_date("fetched_at")).unionByName(
        cache_rows(live.withColumn("run_date", F.col("brief_date")), F.col("fetched_at"), settings.cache_retention_days, ("run_date",))
    )
    tails = _tails_before(spark, folders, todo, settings.archive_limit)
    run = DigestRun(
        DigestInputs(
            dates=todo, candidates=candidate_articles(candidates), live=live, failures=feed_failures(feeds, configured),
            cache=cached, archive=None, sources=configured, configured=configured,
            reports=reports.select(F.col("brief_date").alias("report_date")), skipped=skipped, tails=tails,
        ),
        settings,
    )
    status = staged(run.status, "status")
    documents = staged(run.documents(title), "documents")
    lines = staged(run.archive_rows(), "archive-new")

    # All results are on shared storage before the first table changes. Every table replaces what a run of the
    # same dates left, and documents, which tell what is still to do, come last.
    update_state(live, folders.cache, CACHE_SCHEMA, lambda old, new: upsert_cache(old, new, F.col("fetched_at"), settings.cache_retention_days))
    append_with_tails(lines, folders.archive, folders.archive_tails, settings.archive_limit)
    write_dates(status, folders.status)
    write_dates(documents, folders.documents)
