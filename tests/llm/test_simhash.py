"""Fingerprints and components against brute force."""

import random
import re

import xxhash

from feedloom.llm import components, simhash
from feedloom.llm.components import star_components
from feedloom.llm.queries import op3_simhash
from feedloom.operators.stage import staged

from .helpers import FOLDER, ODD_ROWS, documents, frame, rows_of


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=3):
    """Smallest position reachable, by depth-first search over all pairs."""
    distinct = sorted(set(prints))
    near = {a: [b for b in distinct if (a ^ b).bit_count() <= max_bits] for a in distinct}
    found = {}
    for start in distinct:
        todo = [start]
        while todo:
            at = todo.pop()
            if at not in found:
                found[at] = start
                todo += near[at]
    return [found[p] for p in prints]


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def partition(labels):
    groups = {}
    for at, label in enumerate(labels):
        groups.setdefault(label, []).append(at)
    return sorted(groups.values())


def test_query_against_brute_force(spark):
    docs = documents()
    prints = [plain_fingerprint(d[1]) for d in docs]
    got = {r["doc_id"]: r for r in rows_of(op3_simhash(spark, FOLDER))}
    assert len(got) == len(docs)
    assert [got[d[0]]["fingerprint"] for d in docs] == [f"{p:016x}" for p in prints]
    for group in partition(plain_components(prints)):
        ids = [docs[i][0] for i in group]
        assert {got[i]["component_id"] for i in ids} == {min(ids)}


def test_crowds_chains_and_small_buckets(spark):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    crowd = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(400)}
    one_segment = {centre & ~0xFFFFFFFF | centre & 0xFFFFFFFF ^ sum(1 << b for b in rng.sample(range(32), 5)) for _ in range(300)}
    chain, at = [rng.getrandbits(64)], 0
    for step in range(40):
        chain.append(chain[-1] ^ 7 << step % 60)
    prints = sorted(crowd | one_segment | set(chain) | {rng.getrandbits(64) for _ in range(300)} | {0, 1, 2**63})
    fps = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 3}
    for bucket_rows in (2, 64, 10**6):
        got = [(r.a, r.b) for r in simhash.near_links(fps, 3, bucket_rows).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    links = spark.createDataFrame(sorted(want), "a bigint, b bigint")
    roots = {r.node: r.root for r in star_components(links).collect()}
    assert partition([roots.get(signed(p), signed(p)) for p in prints]) == partition(plain_components(prints))


def test_wider_distance(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(5)]
    prints = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(30)})
    fps = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 5}
    assert {(r.a, r.b) for r in simhash.near_links(fps, 5, 8).collect()} == want


def test_odd_rows(spark):
    found = simhash.near_duplicates(frame(spark, ODD_ROWS, extra=True)).collect()
    assert len(found) == len(ODD_ROWS)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].fp for i in (1, 2, 3)] == [0, 0, 0] and {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert all(signed(plain_fingerprint(r[1])) == by_id[r[0]].fp for r in ODD_ROWS if r[0])
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_long_text_in_pieces(monkeypatch):
    text = ("Alpha beta  gamma\n" * 50 + "z" * 300 + " end") .encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "pieces", lambda x: [x[:400].rpartition(b" ")[0], x[len(x[:400].rpartition(b" ")[0]) :]])
    assert simhash.fingerprint(text) == whole


def test_components_by_broadcast_and_by_tables(spark, monkeypatch):
    rng = random.Random(9)
    links = sorted({tuple(sorted(rng.sample(range(300), 2))) for _ in range(180)} | {(0, i) for i in range(301, 400)})
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in star_components(df).collect()}
    for a, b in links:
        assert found[a] == found[b] <= a
    assert all(found[r] == r for r in found.values())
    monkeypatch.setattr(components, "SMALL_EDGES", 0)
    assert {r.node: r.root for r in star_components(df).collect()} == found


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def planned(monkeypatch, module):
    """Plans of what a module stages from now on: [(label, plan)]."""
    seen = []

    def noted(df, label):
        seen.append((label, plan(df)))
        return staged(df, label)

    monkeypatch.setattr(module, "staged", noted)
    return seen


def test_lookups_and_fingerprints_are_not_broadcast(spark, monkeypatch):
    """The planner takes all these tables for small ones, as it does large ones whose rows come from an explode."""
    seen = planned(monkeypatch, simhash)
    rng = random.Random(11)
    fps = spark.createDataFrame([(signed(rng.getrandbits(64)),) for _ in range(50)], "fp bigint")
    links = simhash.near_links(fps, 3, 2)
    found = simhash.near_duplicates(frame(spark, ODD_ROWS))
    plans = [x for label, x in seen if label == "simhash-met"] + [plan(links), plan(found)]
    assert len(plans) == 4
    assert all("SortMergeJoin" in x and "Broadcast" not in x for x in plans)


def test_kept_documents_are_not_broadcast(spark):
    kept = simhash.one_of_each(frame(spark, ODD_ROWS, extra=True))
    assert "SortMergeJoin" in plan(kept) and "Broadcast" not in plan(kept)
    # Null, empty and blank texts are one component, and rows 5 and 6 have copies of nothing but themselves.
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {2, 3} & set(ids) == set() and {1, 4, 5, 6, 7} <= set(ids)


def test_smallest_neighbours_are_broadcast_by_their_number(spark, monkeypatch):
    rng = random.Random(12)
    links = spark.createDataFrame(sorted({tuple(sorted(rng.sample(range(90), 2))) for _ in range(60)}), "a bigint, b bigint")
    seen = planned(monkeypatch, components)
    want = {r.node: r.root for r in star_components(links).collect()}
    assert sum("BroadcastHashJoin" in x for _, x in seen) == len(seen) - 1
    monkeypatch.setattr(components, "SMALL_EDGES", 0)
    seen.clear()
    assert {r.node: r.root for r in star_components(links).collect()} == want
    assert sum("SortMergeJoin" in x for _, x in seen) > 1 and not any("Broadcast" in x for _, x in seen)
