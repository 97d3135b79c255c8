"""Edited texts by brute force, and the collision rate against the generalised Jaccard similarity."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import weighted_sampling as ws
from feedloom.llm.queries import op10_weighted_sampling

from .helpers import FOLDER, ODD_ROWS, documents, frame, rows_of


def jaccard(first, second):
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in (first, second))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_query_against_brute_force(spark):
    docs = sorted(documents(), reverse=True)
    got = {r["doc_id"]: r for r in rows_of(op10_weighted_sampling(spark, FOLDER))}
    by_text, errors = {}, []
    for (doc_id, text, *_), (_, after, *_) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[doc_id]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        errors += [row["near_edited"] - jaccard(text, edited), row["near_next"] - jaccard(text, after)]
    assert len(set(by_text.values())) >= 0.95 * len(by_text)  # near copies may be alike in all samples
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_collision_rate_with_weights(spark):
    texts = ["a " * 8 + "b " * 2 + "c", "a " * 4 + "b " * 4 + "d", "x y z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = [np.array(r.samples) for r in ws.signatures(df, ["doc_id"], samples=400, terms=256).orderBy("doc_id").collect()]
    assert abs(np.mean(rows[0] == rows[1]) - jaccard(*texts[:2])) < 0.08 and np.mean(rows[0] == rows[2]) == 0


def test_long_texts_without_a_common_word_are_not_alike(spark):
    n = 20000
    texts = [" ".join(f"{name}{i}" for i in range(n)) for name in ("a", "b")] + [" ".join(f"a{i}" for i in range(n // 2, n + n // 2))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = [np.array(r.samples) for r in ws.signatures(df, ["doc_id"], samples=64).orderBy("doc_id").collect()]
    assert np.mean(rows[0] == rows[1]) == 0 and abs(np.mean(rows[0] == rows[2]) - 1 / 3) < 0.2


def test_draws_have_their_distributions(spark):
    row = ws.draws(spark, 64, 400).select(F.flatten(F.collect_list("r")).alias("r"), F.flatten(F.collect_list("b")).alias("b"), F.flatten(F.collect_list("k")).alias("k")).first()
    r, b = np.array(row.r), np.array(row.b)
    c = np.exp(np.array(row.k) - r * b + r)
    for gamma in (r, c):
        assert abs(gamma.mean() - 2) < 0.05 and abs(gamma.var() - 2) < 0.15
    assert abs(b.mean() - 0.5) < 0.01 and abs(np.corrcoef(r, c)[0, 1]) < 0.03


def test_odd_rows(spark):
    rows = ws.fingerprints(frame(spark, ODD_ROWS, extra=True)).collect()
    assert len(rows) == len(ODD_ROWS)
    zeros = "0" * 4 * ws.SAMPLES
    assert all(r.fingerprint == zeros for r in rows if r.doc_id in (1, 2, 3)) and sum(r.doc_id == 6 for r in rows) == 2
    again = max((r for r in rows if r.doc_id == 6), key=lambda r: r.near_next)
    text = next(r[1] for r in ODD_ROWS if r[0] == 6)  # a repeated row follows itself
    half = len(text) // 2
    assert again.near_next == 1.0 and again.edited_sha256 == hashlib.sha256((text[: len(text) - half] + text[:half]).encode()).hexdigest()
    only = ws.fingerprints(frame(spark, [(1, "abc def", "en", "a", 7)])).collect()
    assert only[0].near_next == 1.0 and only[0].edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()
    assert ws.fingerprints(frame(spark, [])).collect() == []
