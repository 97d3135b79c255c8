"""The tree against a plain one over the same points."""

import zlib

import pytest

from feedloom.llm.kd_shards import byte_size, document_dimensions, kd_shards
from feedloom.llm.queries import op1_kd_shards

from .helpers import FOLDER, ODD_ROWS, frame


def plain_tree(points, first, leaves, found):
    """points: (size, doc_id, tie, coordinates, place); sets the leaf of every place."""
    if leaves == 1 or not points:
        for p in points:
            found[p[4]] = first
        return
    dims = range(len(points[0][3]))
    widest = max(dims, key=lambda d: (max(p[3][d] for p in points) - min(p[3][d] for p in points), -d))
    points = sorted(points, key=lambda p: (p[3][widest], p[1] is not None, p[1], p[2]))
    total, before, left = sum(p[0] for p in points), 0, leaves // 2
    sides = [], []
    for p in points:
        sides[(before + p[0] / 2) * leaves > total * left].append(p)
        before += p[0]
    plain_tree(sides[0], first, left, found)
    plain_tree(sides[1], first + left, leaves - left, found)


def points_of(spark, df):
    dims = list(document_dimensions().values())
    rows = df.selectExpr("*", "xxhash64(coalesce(text, '')) AS __tie").select("doc_id", "__tie", byte_size().alias("__size"), *(d.alias(f"d{i}") for i, d in enumerate(dims)))
    return [(r[2], r[0], r[1], tuple(r[3:]), place) for place, r in enumerate(rows.collect())]


@pytest.mark.parametrize("shards", [16, 5, 1])
def test_tree_against_plain_one(spark, shards):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    points, found = points_of(spark, docs), {}
    plain_tree(points, 0, shards, found)
    got = {r.doc_id: r.shard for r in kd_shards(docs, shards).collect()}
    assert got == {p[1]: found[p[4]] for p in points}


def test_query(spark):
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op1_kd_shards(spark, FOLDER).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest, mean = max(r.size for r in rows), sum(sizes.values()) / 16
    assert max(abs(s - mean) for s in sizes.values()) <= 2 * longest
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


def test_one_value_of_all_rows_is_split(spark):
    rows = [(i, "same text", "en", "a", 9) for i in range(400)]
    counts = [r["count"] for r in kd_shards(frame(spark, rows), 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_odd_rows(spark):
    found = kd_shards(frame(spark, ODD_ROWS, extra=True), 16).collect()
    assert len(found) == len(ODD_ROWS) and {r.shard for r in found} <= set(range(16))
    assert {r.size for r in found if r.doc_id in (1, 2)} == {1}
    assert kd_shards(frame(spark, []), 16).collect() == []
    by_bytes = kd_shards(frame(spark, ODD_ROWS), target_bytes=50_000).select("shard").distinct().count()
    assert by_bytes >= 3
