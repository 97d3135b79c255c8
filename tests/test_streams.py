from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from feedloom.operators.health import HEALTH_SCHEMA
from feedloom.plans.validate import read_history, update_health_table, updated_health
from feedloom.sources import tables
from feedloom.streaming import jobs
from test_health import check, empty, frame
from test_sources import ATOM, PAYLOAD, RSS, parse, sources

DAY = date(2024, 5, 1)


def feed(spark, folder, df):
    df.write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def started(spark, rows):
    """Checks with the time their run started: run n on the n-th of May."""
    return frame(spark, rows).withColumn("run_at", F.expr("timestamp '2024-05-01 00:00:00' + make_dt_interval(cast(run_id as int) - 1)"))


def test_runs_spread_over_batches_equal_one_batch(spark, tmp_path):
    dns = "Temporary failure in name resolution"
    whole = [
        check("1", 1, "a", False), check("1", 2, "b", True), check("1", 3, "c", False),
        check("2", 4, "a", False, dns), check("2", 5, "b", False, dns), check("2", 6, "c", False, dns),  # the whole network was down
        check("3", 7, "a", False), check("3", 8, "b", False), check("3", 9, "c", True),
        check("4", 10, "a", False, dns), check("4", 11, "b", False, "HTTP Error 404"),
    ]
    parts = [
        [whole[0], whole[3], whole[6]], [whole[1], whole[4], whole[9]], [whole[2], whole[5], whole[7], whole[8], whole[10]],
        [check("20", 12, "z", True)],
    ]
    out, history = f"{tmp_path}/out", f"{tmp_path}/history"
    for part in parts:
        jobs.update_health(feed(spark, f"{tmp_path}/in", started(spark, part)), out, f"{tmp_path}/log", lateness="5 days", history=history)
    streamed = jobs.read_health(spark, out)
    batch = updated_health(frame(spark, whole), empty(spark))
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.select(*streamed.columns).collect()), key=str)
    assert {r.name: r.status for r in streamed.collect()} == {"a": "unstable", "b": "degraded", "c": "healthy"}
    assert read_history(spark, history).count() == 8  # the discarded run has none, the last run is still open
    # A check of a closed run changes nothing.
    late = started(spark, [check("1", 13, "a", True), check("40", 14, "z", True)])
    jobs.update_health(feed(spark, f"{tmp_path}/in", late), out, f"{tmp_path}/log", lateness="5 days", history=history)
    states = {r.name: r.total_successes for r in jobs.read_health(spark, out).collect()}
    assert states == {"a": 0, "b": 1, "c": 1, "z": 1}


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "state")
    many = frame(spark, [check("1", i, f"s{i}", True) for i in range(1, 200)])
    assert update_health_table(many, path) == 0
    folders = tables._manifest(spark, path, None)["folders"]
    assert len(folders) > 50
    for version in range(1, 6):
        update_health_table(frame(spark, [check(str(version), 200 + version, "s7", False)]), path)
        now = tables._manifest(spark, path, None)["folders"]
        (changed,) = [b for b in folders if folders[b] != now[b]]
        assert len(now) == len(folders)
        folders = now
    assert tables.state_versions(spark, path) == [3, 4, 5]  # older ones are gone, with the folders that only they named
    kept = {f for v in (3, 4, 5) for f in tables._manifest(spark, path, v + 1)["folders"].values()}
    there = {f"{w.name}/{b.name}" for w in (tmp_path / "state" / "data").iterdir() for b in w.iterdir() if b.name.startswith("bucket=")}
    assert there == kept
    state = {r.name: r.total_failures for r in tables.read_state(spark, path, HEALTH_SCHEMA).collect()}
    assert len(state) == 199 and state["s7"] == 5
    assert {r.name: r.total_failures for r in tables.read_state(spark, path, HEALTH_SCHEMA, before=5).collect()}["s7"] == 4


def test_ingest_equals_batch_parse(spark, tmp_path):
    bodies = {"rss": RSS, "atom": ATOM}
    rows = [(DAY, f"{n}|{n}", b, None) for n, b in bodies.items()]
    for row in rows:
        stream = feed(spark, f"{tmp_path}/in", spark.createDataFrame([row], PAYLOAD))
        jobs.ingest_feeds(stream, sources(spark, *bodies), f"{tmp_path}/out", f"{tmp_path}/log")
    found = spark.read.parquet(f"{tmp_path}/out").orderBy("seq").collect()
    batch, _ = parse(spark, bodies)
    assert [(r.seq, r.title, r.url) for r in found] == [(r.seq, r.title, r.url) for r in batch]


def test_cache_over_two_batches(spark, tmp_path, articles):
    for offset, title in ((0, "first"), (1, "second")):
        at = datetime(2024, 5, 1 + offset)
        rows = articles([(DAY, 1, title, "u", "", "x", None)]).withColumn("fetched_at", F.lit(at).cast("timestamp"))
        jobs.update_cache(feed(spark, f"{tmp_path}/in", rows), f"{tmp_path}/out", f"{tmp_path}/log")
    assert [r.title for r in jobs.read_cache(spark, f"{tmp_path}/out").collect()] == ["second"]


def test_counts_drop_late_rows(spark, tmp_path):
    def rows(*days):
        return spark.createDataFrame([(datetime(2024, 5, d), "x") for d in days], "at timestamp, kind string")

    for batch in (rows(1, 1, 20), rows(20, 21), rows(2, 21)):
        jobs.count_days(feed(spark, f"{tmp_path}/in", batch), "at", ["kind"], f"{tmp_path}/out", f"{tmp_path}/log")
    found = {r.day.day: r.n for r in jobs.read_day_counts(spark, f"{tmp_path}/out", ["kind"]).collect()}
    assert found == {1: 2, 20: 2, 21: 2}


def test_late_rows_go_aside(spark, tmp_path):
    def rows(*days):
        return spark.createDataFrame([(None if d is None else datetime(2024, 5, d), i) for i, d in enumerate(days)], "at timestamp, n int")

    for batch in (rows(1, 20, None), rows(2, 18, 25), rows(21, 22, 2, None), rows(1, 1)):
        jobs.split_late(feed(spark, f"{tmp_path}/in", batch), "at", f"{tmp_path}/out", f"{tmp_path}/log")
    accepted = sorted(r["at"].day for r in spark.read.parquet(f"{tmp_path}/out/accepted").collect())
    late = sorted((r["reason"], r["at"] and r["at"].day) for r in spark.read.parquet(f"{tmp_path}/out/late").collect())
    assert accepted == [1, 18, 20, 22, 25]
    assert late == [("late", 1), ("late", 1), ("late", 2), ("late", 2), ("late", 21), ("no time", None), ("no time", None)]
    counts = spark.read.parquet(f"{tmp_path}/out/counts").orderBy("batch").collect()
    assert [(r.n, r.n_accepted, r.n_late) for r in counts] == [(3, 2, 0), (3, 2, 1), (4, 1, 2), (2, 0, 2)]


LINK = "url string, published_at timestamp, fetched_at timestamp"


def test_links_seen_before_are_dropped(spark, tmp_path):
    at = datetime(2024, 5, 1)
    first = [("http://a/1?utm_x=1", at, at), ("http://a/2", None, at), ("http://a/9", None, None)]
    second = [("HTTP://A/1", at + timedelta(days=1), at), ("http://a/3", at, at), ("http://a/2/", None, at)]
    for rows in (first, second):
        stream = feed(spark, f"{tmp_path}/in", spark.createDataFrame(rows, LINK))
        jobs.drop_seen_links(stream, f"{tmp_path}/out", f"{tmp_path}/log")
    found = sorted(r.link_key for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == ["http://a/1", "http://a/2", "http://a/3", "http://a/9"]


def test_state_of_links_stays_bounded(spark, tmp_path):
    """Twenty batches of two days each: the state holds a week, and a link comes back when its time has passed."""
    states, log = [], f"{tmp_path}/log"
    for n in range(20):
        at = datetime(2024, 5, 1) + timedelta(days=2 * n)
        rows = [(f"http://a/{n}-{i}", at, at) for i in range(5)] + [("http://a/again", at, at)]
        spark.createDataFrame(rows, LINK).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(LINK).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    before = jobs._finish

    def watched(writer, checkpoint):
        started = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        started.awaitTermination()
        states.extend(s["numRowsTotal"] for p in started.recentProgress for s in p["stateOperators"])

    jobs._finish = watched
    try:
        jobs.drop_seen_links(stream, f"{tmp_path}/out", log)
    finally:
        jobs._finish = before
    assert len(states) >= 20 and max(states) <= 60 and states[-1] <= 60  # 120 rows came in all
    found = [r.link_key for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(set(found)) == 101 and 2 <= found.count("http://a/again") <= 6


def test_cache_stream_lands_without_gathering_dates(spark, tmp_path, monkeypatch):
    from feedloom.plans import queries

    rows = [(i, f"Title {i}\nText {i}", "en", f"src{i % 5}", 10) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    folders = []
    fresh = queries.fresh_folder
    monkeypatch.setattr(queries, "fresh_folder", lambda session, label: folders.append((label, fresh(session, label))) or folders[-1][1])
    cached = queries.all_queries()["stream_cache"](spark, str(tmp_path))
    assert cached.count() > 0
    # Three batches, and each came as several files: none was gathered into one task.
    landed = [path for label, path in folders if label != "stream-cache"]
    assert len(landed) == 1 and len(list(Path(landed[0]).glob("*.parquet"))) > 3
