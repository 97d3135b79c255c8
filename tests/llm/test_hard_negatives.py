"""Mined negatives against a complete search in plain Python."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedloom.llm import hard_negatives as hn
from feedloom.llm.queries import op12_hard_negatives

from .helpers import FOLDER

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, every=100):
    """Sorted result rows by scoring all pairs."""
    kept = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        kept.append((i, [math.floor(256 * c) for c in vector], int(math.fmod(label + 1, 10)) if i % 7 == 0 else label))
    out = []
    for i, q, label in {(i, tuple(v), lab) for i, v, lab in kept if i % every == 0}:
        scored = [(-sum(a * b for a, b in zip(q, v)), j, lab) for j, v, lab in kept]
        for p, j, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:5]:
            fits = sorted(x for x in scored if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:5]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def table(folder):
    t = pq.read_table(f"{folder}/embeddings.parquet")
    return list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), t["label"].to_pylist()))


def sorted_rows(df):
    return sorted(tuple(r[c] for c in hn.RESULT) for r in df.collect())


def test_query_against_all_pairs(spark):
    want = plain(table(FOLDER))
    assert want and sorted_rows(op12_hard_negatives(spark, FOLDER)) == want


def clustered(n, seed, size=6):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = centres[min(11, int(rng.expovariate(0.5)))]
        rows.append((i, [x + rng.gauss(0, 0.05) for x in c], rng.randrange(4)))
    return rows


@pytest.mark.parametrize("codes, probe, anchor_bytes", [(4, 10, 1 << 24), (8, 300, 700), (1, 1, 1 << 24)])
def test_any_index_gives_the_same_rows(spark, monkeypatch, codes, probe, anchor_bytes):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 37)
    data = clustered(900, 3)
    rows, size = hn.grid_rows(spark.createDataFrame(data, SCHEMA), hn.rotated_label(F.col("vec_id"), F.col("label")))
    found = hn.mine(rows, size, F.pmod("vec_id", F.lit(100)) == 0, codes=codes, probe=probe, anchor_bytes=anchor_bytes)
    assert sorted_rows(found) == plain(data)


def test_walk_prunes_and_bounds(spark):
    data = clustered(3000, 5)
    rows, size = hn.grid_rows(spark.createDataFrame(data, SCHEMA), F.col("label"))
    index = hn.build_index(rows, size, 8)
    everything = [(int(b.cell), np.frombuffer(b.v, "<i4").reshape(-1, size)) for b in index.blocks.collect()]
    assert sum(len(v) for _, v in everything) == index.counts.sum() == 3000
    q = np.array([math.floor(256 * c) for c in data[0][1]])
    top = sorted((s for _, v in everything for s in v @ q), reverse=True)
    cells, bound = hn.walk(index, q, float(top[20]), 0)
    assert 0 < len(cells) < (index.counts > 0).sum() and bound < top[20]
    seen = {c for c in cells}
    assert all(max(v @ q) < top[20] for c, v in everything if c not in seen)
    first, second = index.half_bounds(q)
    sums = [first[c // len(second)] + second[c % len(second)] for c in cells]
    assert sums == sorted(sums, reverse=True) and len(seen) == len(cells)
    assert all((v @ q).max() <= first[c // len(second)] + second[c % len(second)] for c, v in everything)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.5, -0.25], 1), (0, [1.0, 0.5, -0.25], 1), (1, [0.9, 0.5, 0.0], 2), (1, [0.9, 0.5, 0.0], 2), (2, [0.9, 0.4, 0.0], 2), (3, [0.8, 0.4, 0.0], 1),
        (4, [0.8, 0.4, 0.0], 3), (5, [0.8, 0.4], 3), (6, None, 2), (7, [0.9, 0.5, 0.1], 1), (8, [nan, 0.0, 0.0], 2), (9, [inf, 0.0, 0.0], 2),
        (10, [None, 0.0, 0.0], 2), (11, [0.5, 0.5, 0.5], None), (None, [0.9, 0.5, 0.0], 3), (100, [-1.0, -0.5, 0.0], 2), (200, [0.0, 0.0, 0.0], 2),
        (300, [0.1, 0.0, 0.0], 9), (12, [], 1), (13, [0.0, 0.0, 0.0], 5),
    ]
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'clash' AS v", "1 AS anchor", "2 AS cell")
    padded = [(i, None if v is None else v + [0.0] * (3 - len(v)), lab) for i, v, lab in data]
    assert sorted_rows(hn.hard_negatives(df)) == plain(padded)
    assert sorted_rows(hn.hard_negatives(df, every=1)) == plain(padded, 1)
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.hard_negatives(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).collect() == []


def test_scores_beyond_doubles_stay_exact():
    a, b = np.array([[2**30 + 1, 3]]), np.array([[2**30 - 1, 5], [1, 1]])
    assert hn._scores(a, b).tolist() == [[(2**30 + 1) * (2**30 - 1) + 15, 2**30 + 4]]
