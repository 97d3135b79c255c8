"""Source health from check results, for any number of checks per source and run.

A check row has run_id, source_key, name, url, ok, article_count, error, checked_at and ``seq``,
a number that orders all checks (run by run, and by position within a run).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.functions.dates import minus_days
from feedloom.operators.asof import latest_known
from feedloom.operators.segments import cut_segments
from feedloom.settings import DNS_MARKERS, NETWORK_MARKERS

HEALTH_SCHEMA = (
    "source_key string, name string, url string, status string, consecutive_failures int,"
    " total_successes bigint, total_failures bigint, last_checked_at timestamp,"
    " last_success_at timestamp, last_error string, last_article_count int"
)
HISTORY_SCHEMA = "source_key string, seq bigint, checked_at timestamp, status string, last_success_at timestamp"
#: Parts of a run that are held and released by themselves in a stream, so that a large run is spread.
RUN_PARTS = 32


def source_key(name: Column, url: Column) -> Column:
    return F.concat_ws("|", name, url)


def has_marker(error: Column, markers: Sequence[str]) -> Column:
    lowered = F.lower(F.coalesce(error, F.lit("")))
    hit = F.lit(False)
    for marker in markers:
        hit = hit | lowered.contains(marker)
    return hit


def run_flags(checks: DataFrame, run: Sequence[str] = ("run_id",), *more: Column) -> DataFrame:
    """Per run (told apart by the columns ``run``): ``more`` aggregates, counts, ``is_outage`` (name resolution down) and ``is_discarded`` (whole network down)."""
    failed = ~F.col("ok")
    counts = checks.groupBy(*run).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.col("ok")).alias("n_ok"),
        F.count_if(failed).alias("n_failed"),
        F.count_if(failed & has_marker(F.col("error"), DNS_MARKERS)).alias("_dns"),
        F.count_if(failed & has_marker(F.col("error"), NETWORK_MARKERS)).alias("_network"),
        *more,
    )
    others = [c for c in counts.columns if c not in (*run, "checked", "n_ok", "n_failed", "_dns", "_network")]
    enough = F.col("n_failed") >= F.greatest(F.lit(2), F.floor(F.col("checked") / 2))
    none_ok = F.col("n_ok") == 0
    return counts.select(
        *run, *others, "checked", "n_ok", "n_failed",
        (none_ok & enough & (F.col("_dns") == F.col("n_failed"))).alias("is_outage"),
        (none_ok & (F.col("n_failed") > 0) & (F.col("_network") == F.col("n_failed"))).alias("is_discarded"),
    )


def usable_checks(checks: DataFrame, discard: bool = True) -> DataFrame:
    """Checks with ``counts_as_failure``; runs in which the whole network was down are dropped.

    A failure during a name-resolution outage stays in the totals but adds nothing to the streak.
    Only flagged runs take part in the joins, and they hold failures only.
    """
    flags = run_flags(checks)
    kept = checks
    if discard:
        dropped = flags.filter("is_discarded").select("run_id")
        kept = kept.join(dropped, "run_id", "left_anti")
    outages = flags.filter("is_outage").select("run_id", "is_outage")
    marked = kept.join(outages, "run_id", "left")
    return marked.withColumn("counts_as_failure", ~F.col("ok") & F.col("is_outage").isNull()).drop("is_outage")


def closed_runs(checks: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Marked checks, as ``usable_checks`` gives them, of a *stream*: held back until their run is whole.

    Checks carry ``run_at``, the time their run started; one without it takes its own time. A run is closed by the
    watermark: once a run is seen that started more than ``lateness`` later. Until then its checks wait in the state
    store, whatever number of batches they come in, and its flags are counted. A check that comes after its run
    was closed is dropped; ``split_late`` puts such rows aside. State holds open runs only.
    """
    run = ["run_id", "run_at"]
    timed = checks.withColumn("run_at", F.coalesce("run_at", "checked_at")).withWatermark("run_at", lateness)
    part = F.pmod(F.xxhash64("source_key", "seq"), F.lit(RUN_PARTS)).cast("int")
    dealt = timed.withColumn("_part", part)
    # Flags are one row per run, and go to every part that the run has.
    flags = run_flags(dealt, run, F.collect_set("_part").alias("_parts")).filter(~F.col("is_discarded"))
    flags = flags.select(*run, "is_outage", F.explode("_parts").alias("_part"))
    joined = dealt.join(flags, [*run, "_part"])
    return joined.withColumn("counts_as_failure", ~F.col("ok") & ~F.col("is_outage")).drop("is_outage", "_part")


def fold_health(checks: DataFrame, state: DataFrame, threshold: int = 3) -> DataFrame:
    """New health state: ``checks`` (with ``counts_as_failure``) on top of the prior ``state``.

    Two aggregations that combine on the map side. The first finds each source's last success; the
    second counts the failures after it, so only failures of the current streak move in between.
    """
    ok_seq = F.when(F.col("ok"), F.col("seq"))
    totals = checks.groupBy("source_key").agg(
        F.count_if("ok").alias("_ok"),
        F.count_if(~F.col("ok")).alias("_failed"),
        F.max("seq").alias("_last_seq"),
        F.max(ok_seq).alias("_last_ok_seq"),
        F.max_by("checked_at", "seq").alias("_checked_at"),
        F.max_by("checked_at", ok_seq).alias("_ok_at"),
        F.max_by("article_count", "seq").alias("_articles"),
    )
    failures = checks.filter(~F.col("ok")).select("source_key", "seq", "error", "counts_as_failure")
    ends = totals.select("source_key", "_last_seq", "_last_ok_seq")
    tail = (
        failures.join(ends, "source_key")
        .filter(F.col("_last_ok_seq").isNull() | (F.col("seq") > F.col("_last_ok_seq")))
        .groupBy("source_key")
        .agg(
            F.count_if("counts_as_failure").alias("_streak"),
            F.max(F.when(F.col("seq") == F.col("_last_seq"), F.coalesce("error", F.lit("")))).alias("_error"),
        )
    )
    # Names are few: fold them by hash first, then take one per key.
    seen = checks.select("source_key", "name", "url").distinct()
    names = seen.groupBy("source_key").agg(F.min(F.struct("name", "url")).alias("_who"))
    fresh = totals.join(tail, "source_key", "left").join(names, "source_key")
    old = state.select("source_key", F.struct(*[c for c in state.columns if c != "source_key"]).alias("old"))
    both = old.join(fresh, "source_key", "full_outer")

    def number(name: str) -> Column:
        return F.coalesce(F.col(f"old.{name}"), F.lit(0))

    checked = F.col("_last_seq").isNotNull()
    last_ok = checked & F.col("_error").isNull()
    streak = F.coalesce("_streak", F.lit(0)) + F.when(F.col("_last_ok_seq").isNull(), number("consecutive_failures")).otherwise(0)
    status = F.when(last_ok, "healthy").when(streak >= threshold, "unstable").otherwise("degraded")

    def latest(new: Column, name: str) -> Column:
        return F.when(checked, new).otherwise(F.col(f"old.{name}"))

    return both.select(
        "source_key",
        latest(F.col("_who.name"), "name").alias("name"),
        latest(F.col("_who.url"), "url").alias("url"),
        latest(status, "status").alias("status"),
        latest(F.when(last_ok, 0).otherwise(streak), "consecutive_failures").cast("int").alias("consecutive_failures"),
        (number("total_successes") + F.coalesce("_ok", F.lit(0))).cast("bigint").alias("total_successes"),
        (number("total_failures") + F.coalesce("_failed", F.lit(0))).cast("bigint").alias("total_failures"),
        latest(F.col("_checked_at"), "last_checked_at").alias("last_checked_at"),
        F.coalesce("_ok_at", "old.last_success_at").alias("last_success_at"),
        latest(F.coalesce("_error", F.lit("")), "last_error").alias("last_error"),
        latest(F.col("_articles"), "last_article_count").cast("int").alias("last_article_count"),
    )


def health_history(checks: DataFrame, state: DataFrame, threshold: int = 3) -> DataFrame:
    """``streak`` and ``status`` after every check, on top of the prior ``state``; where checks carry ``checked_at``,
    also ``last_success_at``.

    A source's checks are cut into ordered segments. Inside a segment the streak is a running count
    since the last success; what precedes the first success of a segment also gets the streak that
    earlier segments and the prior state hand over.
    """
    counts = F.col("counts_as_failure").cast("int")
    cut = cut_segments(checks, ["source_key"], ["seq"])
    keys = ["source_key", "segment"]
    so_far = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    island = Window.partitionBy(*keys, "_island").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn("_island", F.sum(F.col("ok").cast("int")).over(so_far)).withColumn(
        "_run", F.sum(counts).over(island)
    )
    timed = "checked_at" in checks.columns
    ok_at = F.when(F.col("ok"), F.col("checked_at")) if timed else F.lit(None).cast("timestamp")
    local = local.withColumn("_ok_at", F.last(ok_at, ignorenulls=True).over(so_far))
    # One row per segment: whether it holds a success, its failures after the last one, and when that was.
    tails = local.groupBy(*keys).agg(
        (F.max("_island") > 0).cast("int").alias("_has_ok"), F.max_by("_run", "seq").alias("_tail"), F.max_by("_ok_at", "seq").alias("_last_ok")
    )
    by_source = Window.partitionBy("source_key").orderBy("segment")
    reach = by_source.rowsBetween(Window.unboundedPreceding, 0)
    chain = Window.partitionBy("source_key", "_chain").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    prior = state.select("source_key", F.col("consecutive_failures").alias("_prior"), F.col("last_success_at").alias("_prior_ok"))
    so_far_ok = F.last("_last_ok", ignorenulls=True).over(by_source.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce("_prior", F.lit(0))
    handed = (
        tails.join(prior, "source_key", "left")
        .withColumn("_chain", F.sum("_has_ok").over(reach))
        .withColumn("_end", F.sum("_tail").over(chain) + F.when(F.col("_chain") == 0, start).otherwise(0))
        .select(*keys, F.coalesce(F.lag("_end").over(by_source), start).alias("_handed"), F.coalesce(so_far_ok, "_prior_ok").alias("_handed_ok"))
    )
    joined = local.join(handed, keys)
    streak = F.when(F.col("_island") == 0, F.col("_run") + F.col("_handed")).otherwise(F.col("_run"))
    if timed:
        joined = joined.withColumn("last_success_at", F.coalesce("_ok_at", "_handed_ok"))
    return (
        joined.withColumn("streak", F.when(F.col("ok"), 0).otherwise(streak).cast("int"))
        .withColumn(
            "status",
            F.when(F.col("ok"), "healthy").when(F.col("streak") >= threshold, "unstable").otherwise("degraded"),
        )
        .drop("_island", "_run", "_handed", "_ok_at", "_handed_ok", "segment")
    )


def sources_to_read(
    sources: DataFrame, health: DataFrame, as_of: Column, include_unstable: bool = False, grace_days: int = 3
) -> DataFrame:
    """Sources worth reading: not unstable, or always tried, or with a recent success."""
    if include_unstable:
        return sources
    state = health.select("source_key", F.col("status").alias("_status"), F.col("last_success_at").alias("_ok_at"))
    recent = F.coalesce(F.col("_ok_at") >= minus_days(as_of, grace_days), F.lit(False))
    unstable = F.coalesce(F.col("_status") == "unstable", F.lit(False))
    keep = ~unstable | (F.col("failure_policy") == "always_try") | recent
    return sources.join(state, "source_key", "left").filter(keep).drop("_status", "_ok_at")


def state_as_history(state: DataFrame) -> DataFrame:
    """The health state as the history of one check per source, its last."""
    checked = F.col("last_checked_at").alias("checked_at")
    return state.select("source_key", F.lit(-1).cast("bigint").alias("seq"), checked, "status", "last_success_at")


def skipped_sources(
    sources: DataFrame, history: DataFrame, dates: DataFrame, as_of: Column, include_unstable: bool = False, grace_days: int = 3
) -> DataFrame:
    """(brief_date, source_key): sources that aren't read on a date, by their health at the time ``as_of`` of that date.

    ``as_of`` may use ``brief_date``. A run over many dates so judges each as a run on that date would. Only
    sources that were ever unstable are looked up.
    """
    if include_unstable:
        return sources.select(F.lit(None).cast("date").alias("brief_date"), "source_key").limit(0)
    ever = history.filter(F.col("status") == "unstable").select("source_key").distinct()
    doubtful = sources.filter(F.col("failure_policy") != "always_try").select("source_key").join(ever, "source_key", "left_semi")
    # One row: the list of calendar dates.
    listed = dates.agg(F.collect_set("brief_date").alias("_dates"))
    asked = doubtful.crossJoin(F.broadcast(listed)).select("source_key", F.explode("_dates").alias("brief_date")).withColumn("checked_at", as_of)
    known = latest_known(asked, history.join(ever, "source_key", "left_semi"), ["source_key"], "checked_at", "seq", ["status", "last_success_at"])
    recent = F.coalesce(F.col("last_success_at") >= minus_days(F.col("checked_at"), grace_days), F.lit(False))
    return known.filter((F.col("status") == "unstable") & ~recent).select("brief_date", "source_key")


def validation_counts(checks: DataFrame, health: DataFrame) -> DataFrame:
    """One row: checks made, ok, failed, and sources now unstable."""
    made = checks.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if("ok").alias("healthy_now"),
        F.count_if(~F.col("ok")).alias("failed_now"),
        F.lit(0).cast("bigint").alias("unstable_total"),
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("checked", "healthy_now", "failed_now")]
    unstable = health.agg(*zero, F.count_if(F.col("status") == "unstable").alias("unstable_total"))
    both = made.unionByName(unstable)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])
