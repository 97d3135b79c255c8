"""The stages one by one, each on what its predecessor kept."""

import re

import corpus_pipeline
import public_tokenizers
import pytest

from feedloom.llm import mixing, pii, quality_model
from feedloom.llm.bpe import TreeCodec, decode_documents, read_ranks
from feedloom.llm.queries import llm_queries

from .helpers import FOLDER, ODD_ROWS, frame
from .test_simhash import plain_components, plain_fingerprint


def test_stages_against_brute_force(spark):
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns

    good = stages[0](spark, docs, FOLDER).cache()
    model = quality_model.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = docs.collect()
    passed = [s >= 0.3 for s in model.scores([r.text.encode() for r in rows])]
    assert good.columns == columns and sorted(good.collect()) == sorted(r for r, keep in zip(rows, passed) if keep)

    unique = stages[1](spark, good, FOLDER).cache()
    rows = sorted(good.collect())
    groups = plain_components([plain_fingerprint(r.text) for r in rows])
    first = {}
    for r, g in zip(rows, groups):
        first.setdefault(g, r)
    assert unique.columns == columns and sorted(unique.collect()) == sorted(first.values())

    private = stages[2](spark, unique, FOLDER).cache()
    assert private.columns == columns and private.count() == unique.count()
    new = {r.doc_id: r for r in private.collect()}
    for r in unique.collect():
        addresses = re.findall(r"[\w.]+@[\w.-]+\w", r.text)
        assert not any(a in new[r.doc_id].text for a in addresses)
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)
    back = {r.doc_id: r.text for r in pii.with_pseudonyms(private, pii.session_key(spark), undo=True).collect()}
    assert back == {r.doc_id: r.text for r in unique.collect()}

    mix = stages[3](spark, private, FOLDER).cache()
    plan = {r.doc_id: r.taken for r in mixing.taken_words(*mixing.mix_plan(private)).collect()}
    taken = dict.fromkeys(plan, 0)
    for r in mix.collect():
        taken[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    assert mix.columns == columns and taken == plan

    tokens = stages[4](spark, mix, FOLDER)
    codec = TreeCodec(read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)), public_tokenizers.PATTERN)
    want = sorted((r.doc_id, codec.encoding.encode_ordinary(r.text)) for r in mix.collect())
    assert sorted((r.doc_id, r.ids) for r in tokens.collect()) == want and all(r.restored for r in tokens.collect())
    decoded = decode_documents(spark, tokens, public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.text) for r in decoded.collect()) == sorted((r.doc_id, r.text) for r in mix.collect())


def test_query_runs_all_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in llm_queries()
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r.restored and r.n_tokens == len(r.ids) for r in rows)


@pytest.mark.parametrize("rows", [ODD_ROWS, []])
def test_odd_rows_pass_all_stages(spark, rows):
    docs = frame(spark, rows, extra=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = out
    corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
