from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.operators import digest, status as st
from feedloom.operators.asof import pending_dates, prior_report_dates, published_dates
from feedloom.operators.digest import cited_items, digest_documents, digest_lines, learning_cards, section_items
from feedloom.plans import daily
from feedloom.plans.daily import DigestInputs, DigestRun, recent_articles
from feedloom.settings import Gate, Quota
from feedloom.sources.archive import ARCHIVE_SCHEMA
from feedloom.sources.cache import CACHE_SCHEMA, serve_cache
from test_sources import SOURCE

DAY = date(2024, 5, 1)
SCORED = (
    "brief_date date, seq bigint, title string, url string, summary_short string, stages string, source_name string,"
    " category string, published_at timestamp, total double, keywords array<string>, rank_total double"
)


def scored(spark, rows):
    full = [(DAY, i, f"t{i}", url, "short", "转化", "S", category, None, total, words, total) for i, (total, category, words, url) in enumerate(rows)]
    return spark.createDataFrame(full, SCORED)


def test_sections(spark):
    rows = [
        (4.35, "AI Frontier", [], "a"), (2.05, "AI Frontier", [], "b"), (3.05, "Other", [], "c"), (2.65, "E-commerce & Marketplace", [], "d"),
        (2.8, "Product & Startup Signals", [], "e"), (4.35, "Other", [], "f"), (3.05, "Other", [], "g"),
    ]
    got = section_items(scored(spark, rows)).orderBy("section_no", "pos").collect()
    assert [(r.section, r.pos, r.url) for r in got] == [
        ("must_read", 1, "a"), ("must_read", 2, "f"), ("must_read", 3, "c"), ("ai_watch", 1, "a"), ("ai_watch", 2, "e"), ("marketplace", 1, "d"),
    ]
    cited = cited_items(section_items(scored(spark, rows))).orderBy("cited_pos").collect()
    assert [r.url for r in cited] == ["a", "f", "c", "e", "d"]


@pytest.mark.parametrize(
    "words, tags",
    [
        ([], "#Seller-Growth #Product-Strategy"),
        (["RAG", "Marketplace"], "#Marketplace #Seller-Growth #Product-Strategy"),
        (["China Tech", "AI Agent", "AI Workflow", "AI Analytics", "Retail Media"], "#China-Tech #AI-Agent #AI-Workflow #AI-Analytics #Retail-Media #Seller-Growth"),
        (["AI Agent", "AI Workflow", "AI Analytics", "Retail Media", "Marketplace", "China Tech"], "#AI-Agent #AI-Workflow #AI-Analytics #Retail-Media #Marketplace #China-Tech"),
    ],
)
def test_tags(spark, words, tags):
    items = section_items(scored(spark, [(4.0, "Other", words, "a")]))
    (row,) = digest_lines(cited_items(items), items).collect()
    assert " ".join(row.tags) == tags


def test_lines_and_cards(spark):
    items = section_items(scored(spark, [(4.0, "Other", ["Retail Media"], "a"), (3.9, "Other", ["Seller Tools", "AI Analytics"], "b")]))
    (row,) = digest_lines(cited_items(items), items).collect()
    assert row.one_line_signal.startswith("零售媒体") and "指标异常" in row.thinking_question
    days = spark.createDataFrame([(DAY + timedelta(days=i),) for i in range(4)], "brief_date date")
    cards = {r.brief_date.toordinal() % 4: r.learning_card.concept for r in learning_cards(days).collect()}
    assert cards == {0: "RAG", 1: "Retail Media", 2: "Seller Lifecycle", 3: "Conversion Funnel"}


def test_document(spark):
    items = section_items(scored(spark, [(4.35, "AI Frontier", ["AI Agent"], "http://a")]))
    dates = spark.createDataFrame([(DAY,), (DAY + timedelta(days=1),)], "brief_date date")
    texts = {r.brief_date: r.document for r in digest_documents(items, dates, "My Digest").collect()}
    full, empty = texts[DAY], texts[DAY + timedelta(days=1)]
    assert full.startswith("# My Digest — 2024-05-01\n\n## 0. Today's One-Line Signal\n\n")
    assert "### 1. t0\n\n**发生了什么：** short" in full and "### S / t0" in full and "S / 发布时间未明确" in full
    assert "| t0 | S | 发布时间未明确 | High，评分 4.35 | [阅读](http://a) |" in full and "今天没有筛出足够明确的商家成长信号。" in full
    for heading in ("1. Must Read", "2. AI Product Watch", "3. Marketplace", "4. PM Thinking", "5. 5-Minute", "6. 原文", "7. 今日"):
        assert f"\n\n## {heading}" in full and f"\n\n## {heading}" in empty
    assert "今天没有筛出足够高质量的 Must Read" in empty and empty.endswith("#Seller-Growth #Product-Strategy\n")
    found = published_dates(spark.createDataFrame([(full,), ("# Other — 2024-05-09",)], "text string"), "My Digest")
    assert [r.brief_date for r in pending_dates(dates, found).collect()] == [DAY + timedelta(days=1)]


def test_recent(articles):
    end = datetime(2024, 5, 1, 23, 59, 59, 999999) - timedelta(days=3)
    rows = [(DAY, 0, "t", "u", "", "c", p) for p in (end, end - timedelta(microseconds=1), None, datetime(2030, 1, 1))]
    made = articles([(*r[:1], i, *r[2:]) for i, r in enumerate(rows)])
    assert [r.seq for r in recent_articles(made, 3).orderBy("seq").collect()] == [0, 2, 3]


def test_prior_report_is_strictly_earlier(spark):
    days = [DAY + timedelta(days=i) for i in (0, 1, 5, 400, 800)]
    reports = spark.createDataFrame([(DAY,), (DAY + timedelta(days=4),)], "report_date date")
    found = {r.brief_date: r.prior_date for r in prior_report_dates(spark.createDataFrame([(d,) for d in days], "brief_date date"), reports).collect()}
    last = DAY + timedelta(days=4)
    assert found == {days[0]: None, days[1]: DAY, days[2]: last, days[3]: last, days[4]: last}


@pytest.fixture
def run(spark, articles):
    """A run with empty tables but for those given."""

    def make(dates, candidates=(), live=(), cache=(), archive=(), reports=(), failures=()):
        known = spark.createDataFrame([("S|u", 0, "S", "u", "AI Frontier", 4, "en", 2, "skip_when_unstable")], SOURCE)
        return DigestRun(
            DigestInputs(
                dates=spark.createDataFrame([(d,) for d in dates], "brief_date date"),
                candidates=articles(list(candidates)),
                live=articles(list(live)),
                failures=spark.createDataFrame(list(failures), "brief_date date, source_key string, source_pos int, source_name string, error string"),
                cache=spark.createDataFrame(list(cache), f"run_date date, {CACHE_SCHEMA}"),
                archive=spark.createDataFrame(list(archive), ARCHIVE_SCHEMA),
                sources=known, configured=known.unionByName(known.withColumn("source_key", F.lit("T|t"))),
                reports=spark.createDataFrame([(d,) for d in reports], "report_date date"),
            )
        )

    return make


STRONG = ("Agents automate merchant workflow", "A new dashboard tool for seller analytics, retail media ads and growth platform launch")


def article(day, seq, title, published=None, category="AI Frontier", summary=STRONG[1]):
    return (day, seq, title, f"http://x/{seq}", summary, category, published)


def outcome(run):
    return {r.brief_date: r for r in run.status.collect()}


def test_fresh_run(run):
    live = [article(DAY, 10, "Agents automate merchant workflow"), article(DAY, 11, "agents AUTOMATE merchant workflow!")]
    made = run([DAY], candidates=[article(DAY, 1, "Candidate about agents")], live=live, failures=[(DAY, "T|t", 1, "T", "e")])
    row = outcome(made)[DAY]
    assert (row.fallback_mode, row.preserved_existing, row.candidate_count, row.scored_count) == ("none", False, 3, 2)
    assert (row.fetched_article_count, row.live_article_count, row.candidate_article_count) == (3, 2, 1)
    assert (row.source_count, row.configured_source_count, row.skipped_source_count, row.failed_sources) == (1, 2, 1, ["T"])
    assert row.must_read_count == 2 and row.ai_watch_count == 2
    lines = made.archive_rows().orderBy("line_no").collect()
    assert [(r.line_no % 2**36, r.date) for r in lines] == [(0, "2024-05-01"), (1, "2024-05-01")]
    assert "# Daily Digest — 2024-05-01" in made.documents().first().document
    assert "- Failed sources: T" in st.status_text(made.status).first().text


def cached(run_day, title, fetched, published=None):
    return (run_day, "S|u", "S", "u", "old", 1, "en", fetched, 1, title, "http://c/1", published, STRONG[1])


def test_cache_then_archive_then_existing_report(run):
    days = [DAY + timedelta(days=i) for i in (0, 1, 2, 20)]
    stored = [("2024-01-01", "agent platform", "http://z/1", "S", "AI Frontier", 3.9, "2024-04-26", 0)]
    made = run(
        days,
        live=[article(days[0], 1, STRONG[0], datetime(2024, 4, 30))],
        cache=[cached(days[0] - timedelta(days=5), "From the cache", datetime(2024, 4, 26), datetime(2024, 4, 27))],
        archive=stored,
    )
    rows = outcome(made)
    assert [rows[d].fallback_mode for d in days] == ["none", "feed_cache", "archive", "preserved"]
    # The archive of the third date has what the run wrote for the first two.
    third = made.scored.filter(F.col("brief_date") == days[2]).orderBy("seq").collect()
    assert [r.title for r in third] == ["agent platform", STRONG[0], "From the cache"]
    assert rows[days[3]].output_path == f"brief_date={days[3]}" and rows[days[3]].scored_count == 0
    assert {r.brief_date for r in made.documents().collect()} == set(days[:3])


def test_keys_are_made_before_cached_articles_are_copied(run, monkeypatch):
    """A cached article serves up to eight dates; its keys are worked out once."""
    seen = []

    def serve(short, *rest):
        seen.append(short.columns)
        return serve_cache(short, *rest)

    monkeypatch.setattr(daily, "serve_cache", serve)
    stamp = datetime(2024, 5, 1, 8)
    cache = [(DAY, "S|u", "S", "u", "x", 1, "en", stamp, i, title, f"http://x/{i}", stamp, STRONG[1]) for i, title in enumerate([STRONG[0], STRONG[0].upper()])]
    days = [DAY + timedelta(days=i) for i in range(3)]
    rows = outcome(run(days, cache=cache))
    assert [(rows[d].fallback_mode, rows[d].candidate_count, rows[d].scored_count) for d in days] == [("feed_cache", 2, 1)] * 3
    assert [{"link_key", "title_key"} <= set(columns) for columns in seen] == [True]


def test_old_candidate_returns_as_cache(run):
    made = run([DAY], candidates=[article(DAY, 1, STRONG[0], published=datetime(2024, 4, 26))])
    assert outcome(made)[DAY].fallback_mode == "feed_cache"


def test_weak_fallback_keeps_the_earlier_digest(run):
    stored = [("2024-01-01", "plain", "http://z/1", "S", "E-commerce & Marketplace", 2.7, None, 0)]
    before, after = DAY - timedelta(days=2), DAY + timedelta(days=9)
    row = outcome(run([DAY], archive=[(*s[:3], "Unknown", *s[4:]) for s in stored], reports=[before, after]))[DAY]
    assert (row.fallback_mode, row.preserved_existing, row.marketplace_count, row.scored_count) == ("preserved", True, 1, 1)
    assert row.output_path == f"brief_date={before}"
    row = outcome(run([DAY], archive=[(*s[:3], "Unknown", *s[4:]) for s in stored]))[DAY]
    assert (row.fallback_mode, row.preserved_existing) == ("archive", False)


def test_fresh_but_weak_is_written(run):
    row = outcome(run([DAY], live=[article(DAY, 1, "plain", category="Other", summary="")], reports=[DAY - timedelta(days=1)]))[DAY]
    assert (row.fallback_mode, row.preserved_existing, row.must_read_count) == ("none", False, 0)


def test_nothing_at_all(run):
    made = run([DAY, DAY + timedelta(days=1)])
    rows = outcome(made)
    assert (rows[DAY].fallback_mode, rows[DAY].preserved_existing) == ("none", False)
    # The empty digest of the first date is what the second keeps.
    assert rows[DAY + timedelta(days=1)].preserved_existing
    assert outcome(run([DAY], reports=[DAY]))[DAY].preserved_existing


def test_gate_and_quota(spark, articles):
    good = (DAY, "p", 1, 1, 0, 30, 5, 20, 20, 2, 2, 2, 15, [], False, "none")
    poor = (DAY + timedelta(days=1), "p", 1, 1, 0, 3, 0, 19, 3, 1, 2, 2, 3, [], True, "preserved")
    rows = st.quality_gate(spark.createDataFrame([good, poor], st.STATUS_SCHEMA), Gate()).orderBy("brief_date").collect()
    assert rows[0].sufficient and not rows[1].sufficient
    assert rows[1].reasons == ["preserved", "candidates", "fresh_articles", "must_reads"]
    kinds = ["AI Frontier"] * 8 + ["E-commerce & Marketplace"] * 5 + ["China Tech & Retail"] * 3 + ["Product & Startup Signals"] * 2
    made = articles([(DAY, i, "t", "u", "", k, None) for i, k in enumerate(kinds)])
    assert st.candidate_quota(made).first().meets_quota
    assert not st.candidate_quota(made, Quota(min_ai=9)).first().meets_quota
    assert st.unknown_categories(made.withColumn("category", F.lit("Sports"))).count() == 18


def test_module_ranking_is_total_then_order():
    assert [str(c) for c in digest.ranking()] == ["Column<'rank_total DESC NULLS LAST'>", "Column<'seq ASC NULLS FIRST'>"]
