"""The tree codec against the library that encodes a text as a whole, and as an exact round trip."""

import hashlib
import random

import public_tokenizers
import pytest

from feedloom.llm.bpe import TreeCodec, decode_documents, encode_documents, read_ranks
from feedloom.llm.queries import BYTE_RANKS, op7_bpe

from .helpers import FOLDER, ODD_ROWS, documents, frame

RANKS = read_ranks(public_tokenizers.path(BYTE_RANKS))
SIGNS = ["a", "b", "the", "ing", " ", "  ", "\n", "'", "'s", "'re", "1", "23", "é", "中文", "😀", ".", "!!", "\xa0", "\x1c", "́", "²", "\t"]


def texts(rng, n):
    for _ in range(n):
        kind = rng.random()
        if kind < 0.4:
            yield "".join(rng.choices(SIGNS, k=rng.randint(0, 60)))
        elif kind < 0.7:
            yield "".join(rng.choices("abcdefghinorst", k=rng.randint(0, 300)))
        elif kind < 0.9:
            yield rng.choice(["a", "ab", " ", "'", "0", "é", "中", "'s", "!", "12", "\n", " \n", "-", "!'"]) * rng.randint(0, 300)
        else:
            yield "".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(0x80, 0x3000)])) for _ in range(rng.randint(0, 80)))


@pytest.mark.parametrize("leaf, window, run", [(1, 1, 4), (3, 2, 8), (16, 4, 16), (64, 8, 32)])
def test_joins_equal_whole_encoding(leaf, window, run):
    codec = TreeCodec(RANKS, public_tokenizers.PATTERN, leaf, window, run)
    for text in texts(random.Random(leaf), 1500):
        ids = codec.encode(text)
        assert ids == codec.encoding.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_very_long_runs():
    codec = TreeCodec(RANKS, public_tokenizers.PATTERN)
    for run in (" ", "\n", "-", "!", "\t ", " \n", "é", "'", "x"):
        for text in (run * (30_000 // len(run)), "word" + run * (30_000 // len(run)) + "word", "a" + run * 5_001 + "b1" + run * 4_097):
            assert codec.encode(text) == codec.encoding.encode_ordinary(text), run
    blanks = codec.encode(" " * 2_000_000)
    assert codec.decode(blanks) == b" " * 2_000_000


def test_query_against_whole_encoding(spark):
    codec = TreeCodec(RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in op7_bpe(spark, FOLDER).collect()}
    for doc_id, text, *_ in documents():
        ids = codec.encoding.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    encoded = encode_documents(spark, frame(spark, ODD_ROWS, extra=True), path, pattern, leaf_chars=100)
    found = encoded.collect()
    assert len(found) == len(ODD_ROWS) and all(r.restored and len(r.ids) == r.n_tokens for r in found)
    text = {r[0]: r[1] or "" for r in ODD_ROWS if r[0]}
    assert all(r.text == text[r.doc_id] for r in decode_documents(spark, encoded, path, pattern).collect() if r.doc_id)
    assert encode_documents(spark, frame(spark, []), path, pattern).collect() == []
    special = encode_documents(spark, frame(spark, [(1, "<|endoftext|>", "en", "a", 1)]), path, pattern)
    assert decode_documents(spark, special, path, pattern).first().text == "<|endoftext|>" and 50256 not in special.first().ids
