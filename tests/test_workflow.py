import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom.plans import workflow
from feedloom.plans.workflow import Folders, run_digests, settings_of
from feedloom.plans.validate import update_health_table
from feedloom.sources.archive import day_tails, read_archive, read_tails
from feedloom.sources.cache import CACHE_SCHEMA
from feedloom.sources.candidates import read_candidates
from feedloom.sources.catalogue import read_catalogue
from feedloom.sources.tables import latest_row, read_state, write_dates

PAYLOAD = "brief_date date, source_key string, fetched_at timestamp, body string, error string"


def rss(title, day):
    item = f"<item><title>{title}</title><link>http://a/{day}</link><description>seller workflow dashboard tool platform growth</description></item>"
    return f"<rss><channel>{item}</channel></rss>"


def break_off_at(path):
    def write(df, to, *rest):
        if to == path:
            raise RuntimeError("executor room on fire")
        write_dates(df, to, *rest)

    return write


def test_three_days(spark, tmp_path, monkeypatch):
    config = {
        "lookback_days": 5, "limit_per_source": 4, "weights": {"impact": 0.25, "novelty": 0.2, "source_quality": 0.15, "pm_relevance": 0.25, "actionability": 0.15},
        "sources": [{"name": "A", "url": "a", "category": "AI Frontier", "quality": 5}, {"name": "B", "url": "b", "category": "AI Frontier"}],
    }
    (tmp_path / "sources.json").write_text(json.dumps(config), encoding="utf-8")
    (tmp_path / "candidates").mkdir()
    candidate = [{"title": "Agents for merchants", "url": "http://c/1", "source": "C", "category": "E-commerce & Marketplace", "summary": "retail media ads for seller growth"}]
    (tmp_path / "candidates" / "2024-05-01.json").write_text(json.dumps(candidate), encoding="utf-8")
    catalogue = read_catalogue(spark, str(tmp_path / "sources.json"))
    settings = settings_of(catalogue)
    assert (settings.lookback_days, settings.items_per_source, settings.weights.impact, settings.failure_threshold) == (5, 4, 0.25, 3)

    days = [date(2024, 5, d) for d in (1, 2, 3)]
    payloads = spark.createDataFrame(
        [
            (days[0], "A|a", datetime(2024, 5, 1, 8), rss("AI agent one", 1), None),
            (days[0], "B|b", datetime(2024, 5, 1, 8), None, "URLError: x"),
            (days[1], "A|a", datetime(2024, 5, 2, 8), None, "URLError: x"),
        ],
        PAYLOAD,
    )
    folders = Folders(str(tmp_path / "store"))
    candidates = read_candidates(spark, str(tmp_path / "candidates"))

    def run(asked):
        dates = spark.createDataFrame([(d,) for d in asked], "brief_date date")
        return run_digests(spark, catalogue, payloads, candidates, dates, folders, F.lit("2024-05-04").cast("timestamp"))

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    run(days[:1])
    with pytest.raises(RuntimeError), monkeypatch.context() as broken:  # the last table is not written
        broken.setattr(workflow, "write_dates", break_off_at(folders.documents))
        run(days)
    # The first date is done already, the others are done again.
    status = {r.brief_date: r for r in run(days).collect()}
    assert set(shared.iterdir()) == before  # nothing is left behind
    assert [status[d].fallback_mode for d in days] == ["none", "feed_cache", "feed_cache"]
    assert status[days[0]].failed_sources == ["B"] and status[days[0]].candidate_article_count == 1
    lines = read_archive(spark, folders.archive).orderBy("line_no").collect()
    assert [r.line_no % 2**36 for r in lines] == [0, 1, 0, 0] and [r.date for r in lines] == ["2024-05-01"] * 2 + ["2024-05-02", "2024-05-03"]
    documents = spark.read.parquet(folders.documents)
    assert documents.count() == 3 and "2024-05-03" in latest_row(documents).first().document
    assert [r.title for r in read_state(spark, folders.cache, CACHE_SCHEMA).collect()] == ["AI agent one"]


def dated_rss(day, *titles):
    items = "".join(
        f"<item><title>{t}</title><link>http://a/{day}/{i}</link><description>AI agent seller workflow dashboard tool platform growth</description>"
        f"<pubDate>{'' if i == 0 else f'Wed, {day:02d} May 2024 07:00:00 GMT'}</pubDate></item>"
        for i, t in enumerate(titles)
    )
    return f"<rss><channel>{items}</channel></rss>"


def test_many_dates_at_once_equal_single_runs(spark, tmp_path):
    """Health as of each date, cached content, and an archive that the run itself adds to."""
    config = {
        "lookback_days": 1, "feed_cache_retention_days": 3, "limit_per_source": 30,
        "sources": [{"name": n, "url": n.lower(), "category": c} for n, c in (("A", "AI Frontier"), ("B", "E-commerce & Marketplace"), ("C", "China E-commerce & Retail"))],
    }
    (tmp_path / "sources.json").write_text(json.dumps(config), encoding="utf-8")
    catalogue = read_catalogue(spark, str(tmp_path / "sources.json"))
    at = lambda d, h=8: datetime(2024, 5, d, h)
    many = [f"AI agent number {i}" for i in range(20)]
    payloads = spark.createDataFrame(
        [
            (date(2024, 5, 1), "A|a", at(1), dated_rss(1, *many), None), (date(2024, 5, 1), "B|b", at(1), dated_rss(11, "Shop one", "Shop two"), None),
            (date(2024, 5, 7), "B|b", at(7), dated_rss(7, *(f"Agents {i}" for i in range(9))), None), (date(2024, 5, 7), "C|c", at(7), dated_rss(17, "Left out"), None),
        ],
        PAYLOAD,
    )
    checks = [("C|c", d, h, False) for d, h in ((3, 1), (3, 2), (4, 3))] + [("C|c", 8, 4, True), ("B|b", 2, 5, False), ("B|b", 9, 6, False)]
    rows = [(f"r{d}{h}", k, k[0], k[2:], ok, int(ok), "" if ok else "HTTP Error 404", at(d, h), d * 100 + h) for k, d, h, ok in checks]
    schema = "run_id string, source_key string, name string, url string, ok boolean, article_count int, error string, checked_at timestamp, seq bigint"
    (tmp_path / "candidates").mkdir()
    (tmp_path / "candidates" / "2024-04-01.json").write_text("[]", encoding="utf-8")
    candidates = read_candidates(spark, str(tmp_path / "candidates"))
    days = [date(2024, 5, d) for d in (1, 3, 7, 10, 11)]
    tables = {}
    for name, rounds in (("once", [days]), ("single", [[d] for d in days])):
        folders = Folders(str(tmp_path / name))
        update_health_table(spark.createDataFrame(rows, schema), folders.health, history=folders.health_history)
        for asked in rounds:
            dates = spark.createDataFrame([(d,) for d in asked], "brief_date date")
            as_of = F.col("brief_date").cast("timestamp") + F.expr("interval 9 hours")
            status = run_digests(spark, catalogue, payloads, candidates, dates, folders, as_of)
        lines = read_archive(spark, folders.archive)
        made = day_tails(lines).select("node", "line_no", "url")
        kept = read_tails(spark, folders.archive, folders.archive_tails).select("node", "line_no", "url")
        assert sorted(map(tuple, made.collect())) == sorted(map(tuple, kept.collect()))
        tables[name] = {
            "status": sorted(map(str, status.collect())), "lines": sorted(map(tuple, lines.collect()), key=str),
            "documents": sorted(map(str, spark.read.parquet(folders.documents).collect())),
        }
        modes = {r.brief_date.day: (r.fallback_mode, r.skipped_source_count) for r in status.collect()}
    assert tables["once"] == tables["single"]
    assert {m for m, _ in modes.values()} >= {"none", "feed_cache", "archive"}
    assert [modes[d.day][1] for d in days] == [0, 0, 1, 0, 0]
    late = [r for r in tables["once"]["lines"] if r[0] >= "2024-05-10"]
    assert late and any(r[0] == "2024-05-11" for r in late)
