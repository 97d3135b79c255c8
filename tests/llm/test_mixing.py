"""Targets against the rule applied step by step, and the mix against its plan. The plan has SQL too."""

import re
from collections import Counter

import pytest

from feedloom.llm import mixing

from .helpers import FOLDER, ODD_ROWS, frame


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Shares by weight; what is above twice a source's size is shared among the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, still = share * sum(sizes.values()), set(names)
    while left > 1e-9 and still:
        total = sum(weight[s] for s in still)
        for s in still:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in names)
        for s in names:
            if target[s] >= 2 * sizes[s]:
                target[s] = float(2 * sizes[s])
                still.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70}, {"x": 7}, {"a": 0, "b": 0}, {f"s{i}": i * i for i in range(30)}])
def test_targets(spark, sizes):
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(mixing.weights_in_turn(totals)).collect()}
    assert got == pytest.approx(plain_targets(sizes), abs=1e-6)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_budgets_are_met(spark):
    rows, cuts = mixing.mix_plan(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    taken = mixing.taken_words(rows, cuts).collect()
    for source in {r.source for r in taken}:
        mine = [r for r in taken if r.source == source]
        assert sum(r.taken for r in mine) == round(mine[0].target)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)


def test_documents_of_the_mix(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = {r.doc_id: r.taken for r in mixing.taken_words(*mixing.mix_plan(docs)).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
        assert texts[r.doc_id].startswith(r.text)
    assert got == Counter({i: n for i, n in plan.items() if n})


def test_repeated_ids_and_joined_cuts(spark, monkeypatch):
    rows = [(i % 3, "a b c d e", "en", "s", 9) for i in range(30)] + [(100 + i, "q r s", "en", "t", 5) for i in range(9)]
    docs = frame(spark, rows)
    for bound in (100, 0):  # cuts sent to the executors, or joined
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", bound)
        taken = mixing.taken_words(*mixing.mix_plan(docs)).collect()
        assert len(taken) == len(rows)
        for source, size in (("s", 5), ("t", 3)):
            mine = [r for r in taken if r.source == source]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 11


def test_odd_rows(spark):
    docs = frame(spark, ODD_ROWS, extra=True)
    taken = mixing.taken_words(*mixing.mix_plan(docs)).collect()
    assert len(taken) == len(ODD_ROWS)
    assert all(r.taken == 0 == r.size for r in taken if r.doc_id in (1, 2, 3))
    assert mixing.mixed_documents(docs).columns == docs.columns
    mixing.mixed_documents(docs).collect()
    assert mixing.taken_words(*mixing.mix_plan(frame(spark, []))).collect() == []
    assert mixing.mixed_documents(frame(spark, [])).collect() == []


def test_documents_are_not_broadcast(spark, monkeypatch):
    """The segments that hold a cut come to the documents, whichever side the planner takes for the smaller one."""
    rows = [(i, "word " * (1 + i % 7), "en", f"s{i % 3}" if i % 4 else None, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    def cuts():
        found = mixing.mix_plan(docs)[1]
        return found._jdf.queryExecution().executedPlan().toString(), sorted(map(str, found.collect()))

    plan, want = cuts()
    assert len(want) == 4 and "Inner, BuildRight" in plan and "Inner, BuildLeft" not in plan
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    plan, found = cuts()
    assert found == want and "SortMergeJoin" in plan and "Inner, Build" not in plan
