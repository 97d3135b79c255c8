import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from feedloom.operators import health
from feedloom.plans.validate import update_health_table, updated_health
from feedloom.sources.tables import read_state

CHECK = "run_id string, source_key string, name string, url string, ok boolean, article_count int, error string, checked_at timestamp, seq bigint"
START = datetime(2024, 5, 1)
DNS = "URLError: Temporary failure in name resolution"


def check(run, seq, name, ok, error="HTTP Error 404"):
    return (run, f"{name}|u", name, "u", ok, 3 if ok else 0, "" if ok else error, START + timedelta(hours=seq), seq)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHECK)


def empty(spark):
    return spark.createDataFrame([], health.HEALTH_SCHEMA)


def test_two_failures_make_unstable_and_success_resets(spark):
    rows = [check("1", 1, "a", False), check("2", 2, "a", False)]
    state = updated_health(frame(spark, rows), empty(spark), threshold=2)
    (row,) = state.collect()
    assert (row.status, row.consecutive_failures, row.total_failures, row.last_error) == ("unstable", 2, 2, "HTTP Error 404")
    (row,) = updated_health(frame(spark, [check("3", 3, "a", True)]), state, threshold=2).collect()
    assert (row.status, row.consecutive_failures, row.total_successes, row.total_failures) == ("healthy", 0, 1, 2)
    assert row.last_success_at == START + timedelta(hours=3) and row.last_error == ""


def test_run_flags(spark):
    rows = [check("dns", 1, "a", False, DNS), check("dns", 2, "b", False, DNS)]
    rows += [check("net", 3, "a", False, "curl fallback failed: x"), check("net", 4, "b", False, DNS)]
    rows += [check("mixed", 5, "a", False, DNS), check("mixed", 6, "b", False, "HTTP Error 404")]
    rows += [check("one", 7, "a", False, DNS), check("fine", 8, "a", True)]
    flags = {r.run_id: (r.is_outage, r.is_discarded) for r in health.run_flags(frame(spark, rows)).collect()}
    assert flags == {"dns": (True, True), "net": (False, True), "mixed": (False, False), "one": (False, True), "fine": (False, False)}


def test_outage_adds_to_totals_only(spark):
    rows = [check("1", 1, "a", False), check("1", 2, "b", True)]
    rows += [check("2", 3, "a", False, DNS), check("2", 4, "b", False, DNS)]
    checks = health.usable_checks(frame(spark, rows), discard=False)
    state = {r.name: r for r in health.fold_health(checks, empty(spark)).collect()}
    assert (state["a"].consecutive_failures, state["a"].total_failures) == (1, 2)
    assert (state["b"].consecutive_failures, state["b"].status, state["b"].last_error) == (0, "degraded", DNS)


def test_discarded_run_changes_nothing(spark):
    state = updated_health(frame(spark, [check("1", 1, "a", True)]), empty(spark))
    down = frame(spark, [check("2", 2, "a", False, DNS)])
    assert updated_health(down, state).collect() == state.collect()


def sequential(rows, prior, threshold, outages):
    state = {k: dict(v) for k, v in prior.items()}
    history = {}
    for run, key, name, url, ok, count, error, at, seq in sorted(rows, key=lambda r: r[-1]):
        s = state.setdefault(key, {"streak": 0, "ok": 0, "bad": 0, "ok_at": None})
        if ok:
            s.update(streak=0, ok=s["ok"] + 1, ok_at=at, status="healthy")
        else:
            s["streak"] += run not in outages
            s.update(bad=s["bad"] + 1, status="unstable" if s["streak"] >= threshold else "degraded")
        history[seq] = (s["streak"], s["status"])
    return state, history


def test_fold_and_history_equal_a_sequential_loop(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(600):
        # One source has a third of all checks.
        name = "hot" if seq % 3 == 0 else f"s{rng.randrange(12)}"
        rows.append(check(f"r{seq // 2}", seq, name, rng.random() < 0.4, rng.choice([DNS, "HTTP Error 404"])))
    prior = {
        f"{n}|u": {"streak": k, "ok": 5, "bad": k, "ok_at": START - timedelta(days=9), "status": "degraded"}
        for n, k in (("hot", 2), ("s1", 4), ("gone", 1))
    }
    old = spark.createDataFrame(
        [(k, k.split("|")[0], "u", v["status"], v["streak"], v["ok"], v["bad"], START, v["ok_at"], "e", 0) for k, v in prior.items()],
        health.HEALTH_SCHEMA,
    )
    checks = frame(spark, rows)
    outages = {r.run_id for r in health.run_flags(checks).filter("is_outage").collect()}
    assert outages
    state, history = sequential(rows, prior, 3, outages)
    usable = health.usable_checks(checks, discard=False)
    folded = health.fold_health(usable, old, 3).collect()
    assert {r.source_key: (r.consecutive_failures, r.total_successes, r.total_failures, r.last_success_at, r.status) for r in folded} == {
        k: (v["streak"], v["ok"], v["bad"], v["ok_at"], v["status"]) for k, v in state.items()
    }
    found = health.health_history(usable.repartition(5), old, 3).collect()
    assert {r.seq: (r.streak, r.status) for r in found} == history


def test_sources_to_read(spark):
    now = datetime(2024, 5, 10)
    sources = spark.createDataFrame(
        [("fine", "skip_when_unstable"), ("bad", "skip_when_unstable"), ("always", "always_try"), ("lately", "skip_when_unstable"), ("new", "skip_when_unstable")],
        "source_key string, failure_policy string",
    )
    state = spark.createDataFrame(
        [("fine", "healthy", None), ("bad", "unstable", now - timedelta(days=4)), ("always", "unstable", None), ("lately", "unstable", now - timedelta(days=1))],
        "source_key string, status string, last_success_at timestamp",
    )
    as_of = F.lit(now).cast("timestamp")
    kept = {r.source_key for r in health.sources_to_read(sources, state, as_of).collect()}
    assert kept == {"fine", "always", "lately", "new"}
    assert health.sources_to_read(sources, state, as_of, include_unstable=True).count() == 5


def test_state_table_versions(spark, tmp_path):
    path = str(tmp_path / "health")
    assert update_health_table(frame(spark, [check("1", 1, "a", False)]), path, version=0) == 0
    for _ in range(2):  # a repeated version starts from the one before
        update_health_table(frame(spark, [check("2", 2, "a", False)]), path, version=1)
    (row,) = read_state(spark, path, health.HEALTH_SCHEMA).collect()
    assert row.total_failures == 2
    counts = health.validation_counts(frame(spark, [check("2", 2, "a", False)]), read_state(spark, path, health.HEALTH_SCHEMA)).first()
    assert tuple(counts) == (1, 0, 1, 0)
