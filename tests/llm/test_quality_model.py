"""Hashed features against plain ones, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from feedloom.llm import quality_model as qm
from feedloom.llm.common import read_documents, read_table
from feedloom.llm.queries import op8_quality

from .helpers import FOLDER, ODD_ROWS, frame


def plain_features(text):
    """Features of a text, one by one, as the arrays of the module make them."""
    prime, gram_prime, mask = int(qm._WORD_PRIME), int(qm._GRAM_PRIME), 2**64 - 1
    mixed = lambda v, salt: int(qm._mixed(np.array([v & mask], np.uint64), salt, qm.BUCKETS)[0])
    out = []
    for salt, n in enumerate(qm.NGRAMS, 1):
        for at in range(len(text) - n + 1):
            h = 0
            for b in text[at : at + n]:
                h = (h * gram_prime + b + 1) & mask
            out.append(mixed(h, salt))
    words = text.split()
    for at, word in enumerate(words):
        out.append(mixed(sum((b + 1) * pow(prime, i, 2**64) for i, b in enumerate(word)), 0))
        if at and words[at - 1] == word:
            out.append(mixed(0, len(qm.NGRAMS) + 1))
    return out


def test_scores_do_not_depend_on_neighbours():
    texts = [b"word", b"word", b"", b"word word", b"a word", b"word", b" word b"]
    weights = np.random.default_rng(5).normal(size=qm.BUCKETS)
    total, count = qm.bucket_sums(texts, weights, qm.NGRAMS)
    for at, text in enumerate(texts):
        alone, n = qm.bucket_sums([text], weights, qm.NGRAMS)
        assert count[at] == n[0] == len(plain_features(text)) and total[at] == pytest.approx(alone[0])


TEXTS = [b"", b"a", b"ab cd ab", b"  one one\ttwo  ", "näive 中文 text text".encode(), b"x" * 40]


def test_sums_of_features():
    weights = np.random.default_rng(1).normal(size=qm.BUCKETS)
    total, count = qm.bucket_sums(TEXTS, weights, qm.NGRAMS)
    for at, text in enumerate(TEXTS):
        features = plain_features(text)
        assert count[at] == len(features) and total[at] == pytest.approx(sum(weights[f] for f in features))
        found, shares = qm.bucket_counts(text, qm.BUCKETS, qm.NGRAMS)
        assert sorted(set(features)) == found.tolist()
        if features:
            assert shares == pytest.approx([features.count(f) / len(features) for f in found.tolist()])


def test_long_texts_come_in_parts(monkeypatch):
    weights = np.random.default_rng(2).normal(size=qm.BUCKETS)
    texts = [b"short one", b"some words " * 400, b"", b"tail"]
    whole, n = qm.bucket_sums(texts, weights, qm.NGRAMS)
    monkeypatch.setattr(qm, "_PIECE", 1000)
    parts, m = qm.bucket_sums(texts, weights, qm.NGRAMS)
    assert parts[[0, 2, 3]] == pytest.approx(whole[[0, 2, 3]]) and abs(m[1] - n[1]) < 60 and parts[1] / m[1] == pytest.approx(whole[1] / n[1], abs=0.02)


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in read_table(spark, folder, "labels").collect()}
    rows = op8_quality(spark, folder).collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(tested) > 50 and np.mean([a == b for a, b in tested]) >= 0.93
    assert np.mean([a for a, b in tested if b == 1]) >= 0.98


def test_held_out_labels_and_other_columns_are_not_learned_from(spark):
    docs, labels = read_documents(spark, FOLDER), read_table(spark, FOLDER, "labels")
    model = qm.fit(docs, labels, epochs=2)
    flipped = labels.withColumn("quality", qm.F.when(qm.held_out(), 1 - qm.F.col("quality")).otherwise(qm.F.col("quality")))
    renamed = docs.withColumn("lang", qm.F.lit("zz")).withColumn("source", qm.F.lit("s"))
    again = qm.fit(renamed, flipped, epochs=2)
    assert np.array_equal(model.gaps, again.gaps) and model.bias == again.bias


def test_sample_is_bounded_and_reruns_agree(spark):
    docs, labels = read_documents(spark, FOLDER), read_table(spark, FOLDER, "labels")
    first, second = (qm.fit(docs.repartition(n), labels.repartition(n), sample_rows=20, epochs=1) for n in (1, 5))
    assert np.array_equal(first.gaps, second.gaps)


def test_odd_rows(spark):
    docs = frame(spark, ODD_ROWS, extra=True)
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, None), (None, 1), (6, 0), (8, 1)], "doc_id bigint, quality int")
    model = qm.fit(docs, labels, epochs=1)
    out = qm.with_scores(spark, docs, model, name="__s")
    assert out.columns == [*docs.columns, "__s"]
    rows = out.collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["__s"] <= 1 for r in rows)
    empty = [r["__s"] for r in rows if not (r.text or "")]
    assert len(empty) == 3 and empty == pytest.approx([1 / (1 + np.exp(-model.bias))] * 3)
    for none in (labels.limit(0), labels.filter("quality = 1")):
        constant = qm.fit(docs, none)
        assert set(constant.gaps) == {0.0}
    assert qm.with_scores(spark, frame(spark, []), model).collect() == []
