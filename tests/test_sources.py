import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.operators.ordering import LIVE, article_seq
from feedloom.sources import archive as ar, cache as ca, candidates as cd, catalogue as ct, feeds
from feedloom.sources.tables import latest_row, read_or_empty, write_dates

DAY = date(2024, 5, 1)
PAYLOAD = "brief_date date, source_key string, body string, error string"
SOURCE = (
    "source_key string, source_pos int, source_name string, source_url string, category string, quality int,"
    " language string, tier int, failure_policy string"
)


def sources(spark, *names, category="AI Frontier"):
    rows = [(f"{n}|{n}", i, n, n, category, 4, "en", 2, "skip_when_unstable") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, SOURCE)


def parse(spark, bodies, limit=8):
    rows = [(DAY, f"{n}|{n}", body, None if body is not None else "URLError: timed out") for n, body in bodies.items()]
    parsed = feeds.read_feeds(spark.createDataFrame(rows, PAYLOAD), limit)
    known = sources(spark, *bodies)
    return feeds.feed_articles(parsed, known).orderBy("seq").collect(), feeds.feed_failures(parsed, known).collect()


RSS = """<?xml version="1.0"?><!-- c --><rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>f</title>
<item><title>One &amp;amp; <![CDATA[<b>bold</b>]]></title><link> http://a/1?x=1&amp;amp;y=2 </link>
<description>&lt;p&gt;hello&lt;/p&gt; there</description><pubDate>Wed, 01 May 2024 10:00:00 EST</pubDate></item>
<item><title>No link</title><atom:link href="z"/><link>http://a/2</link></item>
<item><title></title><link>http://a/3</link></item>
<item><title>Four</title><link>http://a/4</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E1</title><link rel="self"/><link rel="x" href="http://b/1"/>
<summary></summary><content>body</content><updated>2024-05-01T10:00:00Z</updated></entry>
<entry><title>E2</title><link href="http://b/2"/><summary>s</summary><published>2024-05-02</published><updated>2024-05-03</updated></entry></feed>"""


def test_rss_and_atom(spark):
    rows, failures = parse(spark, {"rss": RSS, "atom": ATOM})
    assert [(r.title, r.url, r.summary) for r in rows] == [
        ("One & bold", "http://a/1?x=1&y=2", "hello there"), ("Four", "http://a/4", ""), ("E1", "http://b/1", "body"), ("E2", "http://b/2", "s"),
    ]
    assert [r.published_at for r in rows] == [datetime(2024, 5, 1, 15), None, datetime(2024, 5, 1, 10), datetime(2024, 5, 2)]
    assert failures == []


def test_the_cap_counts_invalid_items(spark):
    rows, _ = parse(spark, {"rss": RSS}, limit=3)
    assert [r.title for r in rows] == ["One & bold"]


def test_bad_feeds_become_failures(spark):
    bodies = {
        "cut": RSS[:300], "none": None, "empty": "", "plain": "<feed><entry><title>T</title><link href='u'/></entry></feed>",
        "rdf": "<RDF><channel><item><title>T</title><link>u</link></item></channel></RDF>",
    }
    rows, failures = parse(spark, bodies)
    assert [(r.source_name, r.title) for r in rows] == [("plain", "T")]
    assert {(f.source_name, f.error.split(":")[0]) for f in failures} == {("cut", "ParseError"), ("none", "URLError"), ("empty", "ParseError")}


def test_probe_looks_at_the_first_item_only(spark):
    bodies = {"ok": ATOM, "first_bad": "<rss><channel><item><title/></item><item><title>T</title><link>u</link></item></channel></rss>", "cut": "<rss>"}
    rows = [(DAY, f"{n}|{n}", b, None) for n, b in bodies.items()]
    checks = feeds.probe_sources(spark.createDataFrame(rows, PAYLOAD), sources(spark, *bodies), F.lit("r"), F.col("brief_date").cast("timestamp"))
    assert {(c.name, c.ok, c.article_count, c.error) for c in checks.collect()} == {
        ("ok", True, 1, ""), ("first_bad", False, 0, "no articles returned"), ("cut", False, 0, "ParseError: not well-formed"),
    }


def test_catalogue(spark, tmp_path):
    config = {
        "lookback_days": 5, "weights": {"impact": 0.25},
        "sources": [
            {"name": "A", "url": "a", "category": "AI Frontier"},
            {"name": "B", "url": "b", "category": "AI Frontier", "enabled": False},
            {"name": "C", "url": "c", "category": "x", "quality": 5, "language": "zh", "tier": 1, "failure_policy": "always_try", "enabled": True},
        ],
        "manual_sources": [{"name": "M", "url": "m", "category": "w", "language": "zh", "reason": "r"}],
    }
    path = tmp_path / "sources.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    catalogue = ct.read_catalogue(spark, str(path))
    found = [tuple(r) for r in ct.enabled_sources(catalogue).collect()]
    assert found == [
        ("A|a", 0, "A", "a", "AI Frontier", 3, "en", 2, "skip_when_unstable"), ("C|c", 2, "C", "c", "x", 5, "zh", 1, "always_try"),
    ]
    assert [r.name for r in ct.manual_sources(catalogue).collect()] == ["M"]


def test_candidates(spark, tmp_path):
    full = {"title": "T", "url": "u", "source": "S", "category": "AI Frontier"}
    items = [full, {**full, "source_url": "su", "quality": 5, "language": "zh", "published_at": "2024-05-01T01:00:00Z", "summary": "s"}]
    (tmp_path / "2024-05-01.json").write_text(json.dumps(items, indent=1), encoding="utf-8")
    rows = cd.candidate_articles(cd.read_candidates(spark, str(tmp_path))).orderBy("seq").collect()
    assert [(r.brief_date, r.seq, r.source_url, r.quality, r.language, r.published_at, r.summary) for r in rows] == [
        (DAY, 0, "u", 4, "en", None, ""), (DAY, 1, "su", 5, "zh", datetime(2024, 5, 1, 1), "s"),
    ]
    (tmp_path / "2024-05-02.json").write_text(json.dumps([{"title": "T"}]), encoding="utf-8")
    with pytest.raises(Exception, match="candidate without"):
        cd.candidate_articles(cd.read_candidates(spark, str(tmp_path))).collect()


def live(spark, articles, rows):
    made = articles([(DAY, 0, t, u, "s", "AI Frontier", p) for t, u, p in rows])
    pos = F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("url"))
    return made.withColumn("seq", article_seq(LIVE, F.lit(0), pos))


def test_cache_upsert_and_read(spark, articles):
    at = datetime(2024, 5, 1, 8)
    old = live(spark, articles, [("Old", "u1", at), ("Gone", "u0", at - timedelta(days=8))])
    cache = ca.cache_rows(old, F.lit(at).cast("timestamp"))
    assert {(r.title, r.item_pos) for r in cache.collect()} == {("Old", 2), (None, None)}
    other = cache.withColumn("source_key", F.lit("X|x"))
    fresh = live(spark, articles, [("New", "u2", None)])
    later = F.lit(at + timedelta(days=1)).cast("timestamp")
    merged = ca.upsert_cache(cache.unionByName(other), fresh, later)
    assert {(r.source_key, r.title) for r in merged.filter("title is not null").collect()} == {("S|u", "New"), ("X|x", "Old")}
    # Of several runs the newest makes the entry, and an older run than the entry's changes nothing.
    runs = fresh.withColumn("at", later).unionByName(live(spark, articles, [("Between", "u3", None)]).withColumn("at", F.lit(at).cast("timestamp")))
    merged = ca.upsert_cache(cache, runs, F.col("at"))
    assert [(r.title, r.fetched_at) for r in merged.collect()] == [("New", at + timedelta(days=1))]
    again = ca.upsert_cache(merged, old, F.lit(at).cast("timestamp"))
    assert [r.title for r in again.collect()] == ["New"]
    # A source that delivers old articles only replaces its entry by an empty one.
    emptied = ca.upsert_cache(cache, live(spark, articles, [("Old", "u9", at - timedelta(days=30))]), later)
    assert [(r.source_key, r.title) for r in emptied.collect()] == [("S|u", None)]

    known = spark.createDataFrame([("S|u", 7, "S", "u", "Now", 5, "zh", 2, "p")], SOURCE)
    dated = cache.withColumn("run_date", F.lit(DAY))
    for days, titles in ((6, ["Old"]), (7, [])):
        dates = spark.createDataFrame([(DAY + timedelta(days=days),)], "brief_date date")
        got = ca.serve_cache(ca.cached_articles(dated, known), dated, dates).collect()
        assert [(r.title, r.category, r.quality) for r in got] == [(t, "Now", 5) for t in titles]


def test_a_date_sees_the_newest_run(spark, articles):
    runs = []
    for offset, title in ((0, "first"), (2, "second")):
        day = DAY + timedelta(days=offset)
        rows = articles([(day, 1, title, "u", "", "AI Frontier", None)]).withColumn("run_date", F.col("brief_date"))
        runs.append(ca.cache_rows(rows, F.col("brief_date").cast("timestamp"), run=("run_date",)))
    dates = spark.createDataFrame([(DAY + timedelta(days=n),) for n in range(12)], "brief_date date")
    rows = ca.rows_in_reach(runs[0].unionByName(runs[1]), dates)
    got = ca.serve_cache(rows, rows, dates).collect()
    assert {(r.brief_date - DAY).days: r.title for r in got} == {n: "first" if n < 2 else "second" for n in range(9)}


ARCHIVE = ar.ARCHIVE_SCHEMA


def archive(spark, rows):
    return spark.createDataFrame([("2024-01-01", t, u, s, c, sc, p, n) for n, (t, u, s, c, sc, p) in enumerate(rows)], ARCHIVE)


def test_archive_fallback(spark):
    rows = [
        ("kept", "u1", "A", "x", 3.456, "2024-04-24T00:00:00+00:00"),
        ("too old", "u2", "A", "x", 3.0, "2024-04-23T23:59:59Z"),
        ("again", "u1", "B", "China Tech & Retail", None, None),
        ("", "u3", "A", "x", 3.0, None),
        ("agent", "u4", None, None, 2.0, "2025-01-01"),
    ]
    known = sources(spark, "A", "A", category="AI Frontier").withColumn("quality", F.col("source_pos") + 1)
    dates = spark.createDataFrame([(DAY,)], "brief_date date")
    got = ar.archived_articles(archive(spark, rows), known, dates).orderBy("seq").collect()
    assert [(r.title, r.source_name, r.category, r.quality, r.language, r.total, r.keywords) for r in got] == [
        ("again", "B", "China Tech & Retail", 4, "zh", 3.0, ["China Tech"]),
        ("agent", "Archive", "Product & Startup Signals", 4, "en", 2.0, ["AI Agent", "Product Signal"]),
    ]


def test_archive_tail_equals_brute_force(spark):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(400):
        day = date(2022, 11, 1) + timedelta(days=rng.randrange(800))
        rows.append((f"t{i}", f"u{rng.randrange(90)}", "A", "x", 3.0, None if i % 40 == 0 else day.isoformat()))
    days = [date(2022, 12, 31) + timedelta(days=n) for n in (0, 1, 40, 365, 366, 500, 790, 4000)]
    dates = spark.createDataFrame([(d,) for d in days], "brief_date date")
    found = {}
    for r in ar.newest_for_dates(archive(spark, rows), dates, 7, 5).collect():
        found.setdefault(r.brief_date, set()).add(r.line_no)
    for day in days:
        seen, lines = set(), set()
        for line in range(len(rows) - 1, -1, -1):
            url, published = rows[line][1], rows[line][5]
            if (published is None or published >= (day - timedelta(days=7)).isoformat()) and url not in seen and len(lines) < 5:
                seen.add(url)
                lines.add(line)
        assert found.get(day, set()) == lines


def test_archive_files(spark, tmp_path, articles):
    path = str(tmp_path / "archive")
    scored = articles([(DAY, 2, "b", "u2", "", "x", None), (DAY, 1, "a", "u1", "", "x", datetime(2024, 5, 1, 1))]).withColumns(
        {"total": F.lit(3.0), "rank_total": F.lit(3.0)}
    )
    assert ar.read_archive(spark, path).count() == 0
    next_day = scored.withColumn("brief_date", F.date_add("brief_date", 1))
    for part in (scored, next_day, next_day):  # a repeated run leaves its lines once
        ar.append_archive(ar.archive_rows(part), path)
    stored = ar.read_archive(spark, path)
    first = (DAY - date(1970, 1, 1)).days * ar.LINES_PER_DATE
    assert [(r.line_no, r.title, r.published_at) for r in stored.orderBy("line_no").collect()] == [
        (first, "a", "2024-05-01T01:00:00+00:00"), (first + 1, "b", None),
        (first + ar.LINES_PER_DATE, "a", "2024-05-01T01:00:00+00:00"), (first + ar.LINES_PER_DATE + 1, "b", None),
    ]
    # What was written can be fallen back to.
    dates = spark.createDataFrame([(DAY + timedelta(days=3),)], "brief_date date")
    found = ar.archived_articles(stored, sources(spark, "S"), dates).orderBy("seq").collect()
    assert [(r.title, r.brief_date) for r in found] == [("a", DAY + timedelta(days=3)), ("b", DAY + timedelta(days=3))]


def test_wild_publication_dates(spark):
    rows = [("far", "u1", "A", "x", 3.0, "9999-01-01"), ("late", "u2", "A", "x", 3.0, "2026-01-01"), ("old", "u3", "A", "x", 3.0, "2020-01-01")]
    dates = spark.createDataFrame([(DAY,), (DAY + timedelta(days=400),)], "brief_date date")
    found = ar.newest_for_dates(archive(spark, rows), dates, 7).collect()
    assert sorted((r.brief_date, r.title) for r in found) == sorted((d, t) for d in (DAY, DAY + timedelta(days=400)) for t in ("far", "late"))
    assert ar.newest_for_dates(archive(spark, rows), dates.limit(0), 7).collect() == []


def test_dated_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_or_empty(spark, path, "brief_date date, x int").count() == 0
    for rows in ([(DAY, 1), (DAY + timedelta(days=1), 2)], [(DAY, 3)]):
        write_dates(spark.createDataFrame(rows, "brief_date date, x int"), path)
    table = read_or_empty(spark, path, "x int, brief_date date")
    assert {r.x for r in table.collect()} == {2, 3}
    assert latest_row(table).first().x == 2


def test_a_text_ends_where_its_first_element_begins(spark):
    rss = """<rss><channel><title>f <i>g</i></title>
<item><title>Hello <b>bold</b> rest</title><link>http://a/1</link><description><p>inside</p> after</description></item>
<item><title>Plain &lt;b&gt;escaped&lt;/b&gt; stays</title><link>http://a/2</link><description>one <![CDATA[<em>two</em>]]> <!-- c --> three<br/>four</description></item>
<item><title type="a>b"><!-- c -->Quoted <b x="1">z</b></title><link>http://a/3</link><pubDate>Wed, 01 May 2024 10:00:00 GMT<x/></pubDate></item></channel></rss>"""
    atom = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:m="m"><entry><m:title>First <m:u>x</m:u></m:title><title>Second</title><link href="http://b/1"/>
<content type="xhtml">lead <div><p>body</p></div></content></entry><entry><title>E2</title><link href="http://b/2"/><summary><div>s</div></summary><content>c</content></entry></feed>"""
    rows, failures = parse(spark, {"rss": rss, "atom": atom})
    assert failures == []
    assert [(r.title, r.url, r.summary) for r in rows] == [
        ("Hello", "http://a/1", ""), ("Plain escaped stays", "http://a/2", "one two three"), ("Quoted", "http://a/3", ""),
        ("First", "http://b/1", "lead"), ("E2", "http://b/2", "c"),
    ]
    assert rows[2].published_at == datetime(2024, 5, 1, 10)


def test_no_payload_is_too_long_for_the_patterns(spark):
    item = "<item><title>T</title><link>http://a/1</link></item>"
    bodies = {
        "blank": "\n" * 200_000 + f"<rss><channel>{item}</channel></rss>", "comments": "<!--c-->" * 100_000 + f"<rss><channel>{item}</channel></rss>",
        "data": f"<rss><channel><item><title>{'<![CDATA[a]]>' * 50_000}</title><link>http://a/2</link></item></channel></rss>",
        "attributes": f"<rss><channel><item><title {' '.join(f'''a{i}='x' ''' for i in range(150))}>U<b>v</b></title><link>http://a/3</link></item></channel></rss>",
    }
    rows, failures = parse(spark, bodies)
    assert {r.source_name for r in rows} == set(bodies) and failures == []


def test_newest_payload_of_a_source(spark):
    at = datetime(2024, 5, 1)
    rows = [(DAY, "a", None, "old"), (DAY, "a", at, "x"), (DAY, "a", at, "y"), (DAY, "b", None, "only"), (DAY, "c", at, "same"), (DAY, "c", at, "same")]
    df = spark.createDataFrame([(*r, None) for r in rows], "brief_date date, source_key string, fetched_at timestamp, body string, error string")
    found = [(r.source_key, r.body) for r in feeds.newest_payloads(df).orderBy("source_key").collect()]
    assert found[0][1] in ("x", "y") and found[1:] == [("b", "only"), ("c", "same")]
    assert [(r.source_key, r.body) for r in feeds.newest_payloads(df.repartition(3)).orderBy("source_key").collect()] == found
