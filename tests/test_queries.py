"""Queries against their SQL on the smallest tables; FEEDLOOM_ALL_QUERIES=1 runs all of them."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from feedloom.plans.oracle import all_sql
from feedloom.plans.queries import all_queries

FOLDER = Path("/root/testdata/sf0.001")
CORE = (
    "url_normalize", "html_clean", "score_breakdown", "either_key_dedupe", "must_read_top3", "digest_tags",
    "source_health_history", "cached_articles", "prior_digest_asof", "feed_parse",
)
NAMES = sorted(all_queries()) if os.environ.get("FEEDLOOM_ALL_QUERIES") else CORE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def in_order(names, rows):
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, str(FOLDER))
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert in_order(df.columns, map(tuple, df.collect())) == in_order(columns, cursor.fetchall())
