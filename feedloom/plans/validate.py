"""The source check job: check results on top of the health state, with the history that they make."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.health import HEALTH_SCHEMA, HISTORY_SCHEMA, fold_health, health_history, usable_checks
from feedloom.operators.stage import staged, staged_counted
from feedloom.sources.tables import read_or_empty, update_state

_COLUMNS = ("source_key", "name", "url", "ok", "article_count", "error", "checked_at", "seq", "counts_as_failure")
_HISTORY = ("source_key", "seq", "checked_at", "status", "last_success_at")


def updated_health(checks: DataFrame, state: DataFrame, threshold: int = 3) -> DataFrame:
    """New state after all runs in ``checks``; runs with the whole network down change nothing.

    The raw checks are read twice, for the flags of runs and for the narrow marked checks all later steps use.
    """
    return fold_health(staged(usable_checks(checks).select(*_COLUMNS), "checks"), state, threshold)


def fold_into_table(marked: DataFrame, path: str, threshold: int = 3, version: int | None = None, history: str | None = None) -> int | None:
    """Fold marked checks of whole runs into the stored state, and write the history they make below ``history``.

    Only the buckets of the sources that were checked are read and written. History is a folder per version, so a
    repeated version replaces its own. Without any check there is no new version, and None is returned.
    """
    marked, n = staged_counted(marked.select(*_COLUMNS), "checks")
    if n == 0:
        return None

    def merge(old: DataFrame, checks: DataFrame) -> DataFrame:
        # The checks cover a few buckets; the state of these is small and read twice.
        old = staged(old, "health-old")
        merge.rows = health_history(checks.select("source_key", "seq", "ok", "counts_as_failure", "checked_at"), old, threshold) if history else None
        return fold_health(checks, old, threshold)

    number = update_state(marked, path, HEALTH_SCHEMA, merge, version)
    if history:
        merge.rows.select(*_HISTORY).write.mode("overwrite").parquet(f"{history}/version={number}")
    return number


def update_health_table(checks: DataFrame, path: str, threshold: int = 3, version: int | None = None, history: str | None = None) -> int | None:
    """``fold_into_table`` of raw checks; runs with the whole network down are left out."""
    return fold_into_table(usable_checks(checks), path, threshold, version, history)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Status after every check, of all versions."""
    return read_or_empty(spark, path, HISTORY_SCHEMA).drop("version")
