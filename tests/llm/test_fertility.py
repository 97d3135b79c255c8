"""Counts by brute force, measures by the libraries on whole texts, and bands by sorting."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from feedloom.llm import fertility
from feedloom.llm.bpe import TreeCodec, read_ranks
from feedloom.llm.queries import BYTE_RANKS, PIECE_MODEL, op9_fertility

from .helpers import FOLDER, ODD_ROWS, documents, frame, rows_of


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


REPEATING = [
    "a b c d e f g h " * 3, "a " * 30, "x y\nx y\n\n \nx y \n", "one two three four five six seven eight nine one two three four five six seven eight",
    "# * $ | < > % & é 中\x85文", "", "a b c d e f g",
]


@pytest.mark.parametrize("text", REPEATING)
def test_counts(text):
    assert fertility.base_counts(text.encode()) == plain_counts(text)


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in rows_of(op9_fertility(spark, FOLDER))}
    bpe = TreeCodec(read_ranks(public_tokenizers.path(BYTE_RANKS)), public_tokenizers.PATTERN).encoding
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    for doc_id, text, *_ in documents():
        row = got[doc_id]
        want = plain_counts(text)
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert row["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert row["kept"] == (not row["base_failed"] and not row["band_failed"])
        ids, parts = bpe.encode_ordinary(text), pieces.encode(text, out_type=str)
        assert row["n_tokens"] == len(ids) and row["byte_chars"] == pytest.approx(len(text) / len(ids))
        assert row["piece_chars"] == pytest.approx(len(text) / len(parts))
        fallback = [p for p in parts if re.fullmatch("<0x[0-9A-F]{2}>", p) and not 9 <= int(p[3:5], 16) <= 13]
        assert row["fallback"] == pytest.approx(len(fallback) / len(parts))
        share = np.array(list(Counter(ids).values())) / len(ids)
        assert row["entropy"] == pytest.approx(-(share * np.log2(share)).sum())


def test_bands_against_sorting(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "en" if i % 3 else "de", 100, *map(float, rng.gamma(5, 0.4, 4))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, grouping string, n_tokens bigint, byte_chars double, piece_chars double, fallback double, entropy double")
    names = ("byte_chars", "piece_chars", "fallback", "entropy")
    for r in fertility.bands(df).collect():
        grid = fertility.GRID[r.measure]
        bins = sorted(int(x[3 + names.index(r.measure)] // grid) for x in rows if x[1] == r.grouping)
        q25, q50, q75 = (bins[int(np.ceil(q * len(bins))) - 1] for q in (0.25, 0.5, 0.75))
        middle = (q50 + 0.5) * grid
        least = max(middle * fertility.LEAST_SPREAD, grid)
        assert r["class"] == 6
        assert r.low == pytest.approx(middle - fertility.BAND * max((q50 - q25) * grid, least))
        assert r.high == pytest.approx(middle + fertility.BAND * max((q75 - q50) * grid, least))


def test_small_and_mixed_classes_are_held_against_a_coarser_band(spark):
    rng = np.random.default_rng(4)
    row = lambda i, group, script, n, entropy, chars=4.0: (i, group, script, 50, 0, n, chars + rng.normal(0, 0.1), 4.0, 0.0, entropy * np.log2(n) / 10)
    rows = [row(i, "en", "latin", 100, 8 + rng.normal(0, 0.1)) for i in range(300)]
    rows += [row(1000, "en", "latin", 10000, 0.5), row(1001, "en", "latin", 10000, 8.0), row(1002, "en", "latin", 20, 8.0, 40.0)]
    rows += [row(1003, "is", "latin", 100, 8.0, 40.0), row(1004, "is", "latin", 100, 8.0), row(1005, "am", "ethiopic", 100, 8.0, 40.0)]
    # Every second text of this class is bad: its own band would take in all of them.
    rows += [row(2000 + i, "en", "latin", 5000, 8.0 if i % 2 else 1.0) for i in range(60)]
    columns = "doc_id bigint, grouping string, script string, n_words bigint, n_repeat_words bigint, n_tokens bigint, byte_chars double, piece_chars double, fallback double, entropy double"
    got = {r.doc_id: r.band_failed for r in fertility.verdicts(spark.createDataFrame([tuple(x.item() if isinstance(x, np.generic) else x for x in r) for r in rows], columns)).collect()}
    assert len(got) == len(rows)
    assert [got[i] for i in range(1000, 1006)] == ["entropy", "", "byte_chars", "byte_chars", "", "byte_chars"]
    assert {got[2000 + i] for i in range(0, 60, 2)} == {"entropy"} and {got[2000 + i] for i in range(1, 60, 2)} == {""}


def test_clean_labelled_documents_are_kept(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op9_fertility(spark, folder).collect() if not r.base_failed]
    clean = [r.band_failed == "" for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.band_failed == "" for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(clean) >= 0.98 and np.mean(bad) < np.mean(clean)


def test_odd_rows(spark):
    paths = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, public_tokenizers.path(PIECE_MODEL)
    rows = fertility.verdicts(fertility.measure_documents(spark, frame(spark, ODD_ROWS, extra=True), *paths)).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert r.base_failed and not r.kept
    assert {r.grouping for r in rows if r.doc_id == 3} == {"script:none"}
    assert fertility.verdicts(fertility.measure_documents(spark, frame(spark, []), *paths)).collect() == []
    assert fertility.script_of("абв abc г") == "cyrillic"


def test_short_text_takes_no_table_of_the_vocabulary():
    with open(public_tokenizers.path(BYTE_RANKS), "rb") as ranks:
        byte_bpe = fertility._byte_bpe(ranks.read(), public_tokenizers.PATTERN)
    fertility.byte_measures(b"warm up", byte_bpe)
    tracemalloc.start()
    fertility.byte_measures(b"one two three", byte_bpe)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < byte_bpe.n_vocab  # a table of counts has eight bytes a token


def test_long_text_sums_up_its_pieces(monkeypatch):
    with open(public_tokenizers.path(BYTE_RANKS), "rb") as ranks, open(public_tokenizers.path(PIECE_MODEL), "rb") as proto:
        byte_bpe, (model, is_byte) = fertility._byte_bpe(ranks.read(), public_tokenizers.PATTERN), fertility._piece_model(proto.read())
    texts = ["one two 中 three one two ".encode() * 40, b"", "café \U0001f600 x\x0by".encode(), b"a b"]
    whole = fertility.measures(texts, byte_bpe, model, is_byte)
    monkeypatch.setattr(fertility, "PIECE_BYTES", 64)
    cut = fertility.measures(texts, byte_bpe, model, is_byte)
    for text, one, many in zip(texts, whole, cut):
        ids = byte_bpe.encode_ordinary(text.decode())
        share = np.array(list(Counter(ids).values())) / max(1, len(ids))
        assert one[0] == len(ids) and one[4] == pytest.approx(-(share * np.log2(share)).sum() if ids else 0.0)
        assert many[:2] == pytest.approx(one[:2], rel=0.1) and many[4] == pytest.approx(one[4], rel=0.1)
