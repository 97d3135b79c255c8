import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import dedupe
from feedloom.operators.dedupe import dedupe_articles, first_unique
from feedloom.operators.segments import add_rank, top_rows

KEYED = "day int, seq bigint, link_key string, title_key string"


def found(spark, rows):
    return {tuple(r) for r in first_unique(spark.createDataFrame(rows, KEYED), ["day"]).collect()}


def holds(rows, kept):
    """No two rows that stay share a key, and every other row shares one with an earlier row that stays."""
    links, titles = {}, {}
    for day, seq, link, title in rows:
        if (day, seq) in kept:
            assert (day, link) not in links and (day, title) not in titles
            links[day, link] = titles[day, title] = seq
    for day, seq, link, title in rows:
        if (day, seq) not in kept:
            assert min(links.get((day, link), seq), titles.get((day, title), seq)) < seq


def test_tracking_links_and_titles(spark):
    rows = [
        (1, "Agents launch", "https://Ex.com/a?utm_source=x"),
        (2, "Other title", "https://ex.com/a/"),
        (3, "Agents: LAUNCH!", "https://elsewhere.com/b"),
    ]
    kept = dedupe_articles(spark.createDataFrame(rows, "seq bigint, title string, url string"), [])
    assert [r.seq for r in kept.collect()] == [1]


def test_a_dropped_row_claims_nothing(spark):
    rows = [(0, 1, "u1", "t1"), (0, 2, "u2", "t1"), (0, 3, "u2", "t2")]
    assert found(spark, rows) == {(0, 1), (0, 3)}


def test_random_rows(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(rng.randrange(2), seq, f"u{rng.randrange(40)}", f"t{rng.randrange(40)}") for seq in range(150)]
        # A third of all rows share one title.
        rows += [(0, 1000 + i, f"v{rng.randrange(60)}", "") for i in range(75)]
        holds(rows, found(spark, rows))


def test_long_chains_take_few_rounds(spark, monkeypatch):
    rounds = []
    settle = dedupe._staying
    monkeypatch.setattr(dedupe, "_staying", lambda *args: rounds.append(1) or settle(*args))
    up = [(0, i, f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(500)]
    down = [(1, 500 - i, f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(301)]
    kept = found(spark, up + down)
    assert kept == {(0, i) for i in range(0, 500, 2)} | {(1, 500 - i) for i in range(300, -1, -2)}
    assert len(rounds) == 1


def test_null_keys_are_empty_keys(spark):
    rows = [(0, i, None, f"t{i}") for i in range(14)] + [(0, 20, "", "x"), (0, 21, "u", None), (0, 22, "v", ""), (0, 23, "w", "y")]
    assert found(spark, rows) == {(0, 0), (0, 21), (0, 23)}


def test_repeated_seq_stops_the_job(spark):
    with pytest.raises(Exception, match="seq is not unique"):
        found(spark, [(0, 4, "u1", "zero"), (0, 5, "u2", "zero"), (0, 5, "u3", "two")])


def test_positions_out_of_range_stop_the_job(spark):
    from feedloom.operators.ordering import LIVE, article_seq

    rows = spark.createDataFrame([(2**20 - 1, 2**40 - 1), (2**20, 0)], "s bigint, i bigint")
    assert rows.filter("i > 0").select(article_seq(LIVE, F.col("s"), F.col("i")).alias("q")).first().q == 2**61 - 1
    with pytest.raises(Exception, match="position out of range"):
        rows.select(article_seq(LIVE, F.col("s"), F.col("i"))).collect()


def test_no_rows(spark):
    assert first_unique(spark.createDataFrame([], KEYED), ["day"]).collect() == []


def test_rank_over_a_crowded_group(spark):
    rng = random.Random(5)
    rows = [(0 if i % 3 else i, i, rng.randrange(5)) for i in range(500)]
    frame = spark.createDataFrame(rows, "day int, seq bigint, total int").repartition(7)
    ranked = add_rank(frame, ["day"], [F.desc("total"), F.asc("seq")]).collect()
    expected = {}
    for day in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == day), key=lambda r: (-r[2], r[1]))
        expected.update({r[1]: i for i, r in enumerate(group, 1)})
    assert {r.seq: r["rank"] for r in ranked} == expected


def test_top_rows(spark):
    frame = spark.createDataFrame([(d, i) for d in range(3) for i in range(10)], "d int, i int")
    assert {(r.d, r.i, r.pos) for r in top_rows(frame, ["d"], [F.desc("i")], 2).collect()} == {
        (d, i, p) for d in range(3) for i, p in ((9, 1), (8, 2))
    }
