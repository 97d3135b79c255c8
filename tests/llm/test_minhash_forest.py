"""Components against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from feedloom.llm import minhash_forest as mf
from feedloom.llm.queries import op11_minhash_forest

from .helpers import FOLDER, ODD_ROWS, documents, frame


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain(rows):
    """Sorted (doc_id, n_shingles, component_id, kept) by comparing all pairs of distinct sets."""
    classes = {}
    for row in rows:
        classes.setdefault(plain_set(row[1]), []).append(row[0])
    sets = sorted((s for s in classes if s), key=len)
    near = {s: [] for s in sets}
    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            if 100 * len(a) < 85 * len(b):
                break
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                near[a].append(b)
                near[b].append(a)
    smallest, order = {}, lambda i: (i is None, i or 0)
    for s in sets:
        if s not in smallest:
            reach, todo = {s}, [s]
            while todo:
                for t in near[todo.pop()]:
                    if t not in reach:
                        reach.add(t)
                        todo.append(t)
            first = min((i for t in reach for i in classes[t]), key=order)
            smallest |= {t: first for t in reach}
    found = []
    for row in rows:
        s = plain_set(row[1])
        component = smallest[s] if s else row[0]
        found.append((row[0], len(s), component, row[0] == component))
    return sorted(found, key=lambda r: (order(r[0]), r[1]))


def sorted_rows(df):
    rows = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_query_against_all_pairs(spark):
    docs = documents()
    assert sorted_rows(op11_minhash_forest(spark, FOLDER)) == plain(docs)


def crowds():
    """A hub whose copies link with it only, a chain, one passage in many texts, and copies of one text."""
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(4000))
    texts, hub = [], [word() for _ in range(104)]
    texts.append(hub)
    for _ in range(150):
        copy = list(hub)
        copy[rng.randrange(5, 99)] = word()
        texts.append(copy)
    chain = [word() for _ in range(300)]
    for _ in range(12):
        chain = [*chain[7:], *(word() for _ in range(7))]
        texts.append(chain)
    passage = [word() for _ in range(60)]
    for _ in range(150):
        texts.append([*(word() for _ in range(rng.randrange(10, 60))), *passage])
    pairs = [[*texts[i][:-1], "end"] for i in range(170, 200)]
    rows = [(i, " ".join(t), "en", "a", 0) for i, t in enumerate([*texts, *pairs])]
    return rows + [(1000 + i, rows[40][1].upper(), "en", "b", 0) for i in range(80)]


@pytest.mark.parametrize("reach", [2, 24])
def test_crowded_regions_lose_no_link(spark, reach):
    rows = crowds()
    df = frame(spark, rows).repartition(7)
    assert sorted_rows(mf.near_duplicates(df, reach=reach)) == plain(rows)


def test_rest_step_alone_finds_all_links(spark):
    """With components unknown, the pairs of the rest step hold every link among its classes."""
    rows = crowds()
    forest = mf._Forest(frame(spark, rows), "doc_id", "text", 5, 24)
    facts = forest.classes.select(*mf._FACTS, "set_id").select(*mf._FACTS, forest.classes["set_id"].alias("root"))
    links = forest.confirmed(forest.rest(forest.classes.select("set_id"), facts), "rest")
    sets = list({plain_set(r[1]) for r in rows})
    want = sum(
        100 * len(a & b) >= 85 * len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :]
    )
    assert links.count() == want > 200


def test_minima_estimate_similarity():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.85):
        equal, bits = [], []
        for _ in range(40):
            both, own = int(300 * share), 300 - int(300 * share)
            pool = rng.integers(0, 2**64, both + 2 * own, np.uint64)
            a, b = (np.unique(np.concatenate([pool[:both], x])) for x in (pool[both : both + own], pool[both + own :]))
            true = both / (both + 2 * own)
            x, y = mf.minima(a), mf.minima(b)
            equal.append((x == y).mean() - true)
            same = 2 * mf.SKETCH - int(np.bitwise_count((mf.sketch(x) ^ mf.sketch(y)).view(np.uint64)).sum())
            bits.append(same / 2 / mf.SKETCH - (1 + true) / 2)
        assert abs(np.mean(equal)) < 0.02 and abs(np.mean(bits)) < 0.02
        assert np.std(equal) < 0.05


def test_odd_rows(spark):
    got = sorted_rows(mf.near_duplicates(frame(spark, ODD_ROWS, extra=True)))
    assert got == plain(ODD_ROWS)
    assert mf.near_duplicates(frame(spark, [])).collect() == []


def test_long_text_in_pieces(monkeypatch):
    text = ("Alpha beta  gamma\n" * 50 + "z" * 300 + " one two three four five six end").encode()
    whole = mf.shingle_set(text)
    cut = len(text[:900].rpartition(b" ")[0])
    monkeypatch.setattr(mf, "pieces", lambda x: [x[:cut], x[cut:]])
    assert mf.shingle_set(text).tolist() == whole.tolist()
