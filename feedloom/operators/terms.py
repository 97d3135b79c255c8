"""Which of many terms occur in a text. Terms are substrings, not words.

``list_hits`` looks for the terms of a few lists at once, in the task that has the text: a text is gone through once, not
once per term. ``term_hits`` is a join, for lexicons too long to be sent to every task. There, every term is filed under one short gram of it, the one that the fewest terms have, and
texts are cut into pieces whose grams look the terms up; what a lookup fetches is verified on the piece. Pieces overlap
by the longest term, so no occurrence is cut. Work grows with the text and the matches, not with text times terms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

GRAM = 4
PIECE = 64
#: Bytes of text that are searched at once.
WINDOW = 1 << 20


def _starts(part: np.ndarray, terms: Sequence[bytes]) -> Iterator[np.ndarray]:
    """Per term, the places of ``part`` at which it starts. Only where the term's rarest pair of bytes stands are the
    others compared."""
    pairs = part[:-1].astype(np.uint16) << 8 | part[1:]
    often = np.bincount(pairs[: 1 << 16], minlength=1 << 16)
    anchors = []
    for term in terms:
        codes = [first << 8 | second for first, second in zip(term, term[1:])]
        anchors.append(min(((often[code], at, code) for at, code in enumerate(codes)), default=None))
    wanted = np.zeros(1 << 16, bool)
    wanted[[code for _, _, code in filter(None, anchors)]] = True
    places = np.flatnonzero(wanted[pairs])
    kinds = pairs[places]
    order = np.argsort(kinds, kind="stable")
    places, kinds = places[order], kinds[order]
    for term, anchor in zip(terms, anchors):
        if anchor is None:
            yield np.flatnonzero(part == term[0])
            continue
        _, at, code = anchor
        low, high = np.searchsorted(kinds, [code, code + 1])
        starts = places[low:high] - at
        starts = starts[(starts >= 0) & (starts <= len(part) - len(term))]
        for k in range(len(term)):
            if k not in (at, at + 1):
                starts = starts[part[starts + k] == term[k]]
        yield starts


def occurring(texts: pa.Array, terms: Sequence[bytes]) -> np.ndarray:
    """A row per text and a column per term: whether the term stands in the text, byte for byte."""
    found = np.zeros((len(texts), len(terms)), bool)
    sought = [i for i, term in enumerate(terms) if term]
    found[:, [i for i, term in enumerate(terms) if not term]] = True
    longest = max((len(term) for term in terms), default=0)
    if not len(texts) or not longest:
        return found
    whole = texts.cast(pa.large_binary())
    _, ends, body = whole.buffers()
    edges = np.frombuffer(ends, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(body or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    for at in range(0, len(data), WINDOW):
        # A window goes on into the next one as far as a term can.
        part = data[at : at + WINDOW + longest - 1]
        for i, starts in zip(sought, _starts(part, [terms[i] for i in sought])):
            rows = np.searchsorted(edges, starts + at, "right") - 1
            found[rows[starts + at + len(terms[i]) <= edges[rows + 1]], i] = True
    return found


def list_hits(text: Column, lists: Sequence[Sequence[str]]) -> Column:
    """An array with the number of terms of each list that occur in ``text``, which is not null."""
    terms = list(dict.fromkeys(term.encode() for words in lists for term in words))
    listed = np.array([[words.count(term.decode()) for words in lists] for term in terms], np.int32).reshape(len(terms), len(lists))

    @F.arrow_udf("array<int>")
    def hits(texts: pa.Array) -> pa.Array:
        counts = occurring(texts, terms).astype(np.int32) @ listed
        return pa.ListArray.from_arrays(np.arange(len(counts) + 1, dtype=np.int32) * len(lists), pa.array(counts.ravel()))

    return hits(text.cast("binary"))


def _grams(text: str, size: int):
    """All grams of ``size`` signs of a term."""
    signs = F.split(text, "")
    return F.transform(F.slice(signs, 1, F.greatest(F.lit(0), F.size(signs) - size + 1)), lambda _, i: F.array_join(F.slice(signs, i + 1, F.lit(size)), ""))


def anchored(terms: DataFrame, gram: int = GRAM) -> DataFrame:
    """(gram, group, term): each term under its rarest gram among terms; a shorter term is its own gram."""
    listed = terms.filter(F.length("term") > 0).select("group", "term").distinct()
    each = listed.withColumn("gram", F.explode(F.when(F.length("term") <= gram, F.array("term")).otherwise(F.array_distinct(_grams("term", gram)))))
    shared = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = each.join(shared, "gram").groupBy("group", "term").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return rarest.select("gram", "group", "term")


def term_hits(texts: DataFrame, terms: DataFrame, keys: list[str], text: str = "text", gram: int = GRAM) -> DataFrame:
    """(keys, group, hits): how many distinct terms of a group occur in the text of a key; none have no row.

    ``terms`` has (group, term); terms and texts are compared as they are. A key's texts are searched apart and counted
    together. Null texts and empty terms match nothing.
    """
    facts = terms.agg(F.max(F.length("term")).alias("longest"), F.collect_set(F.least(F.length("term"), F.lit(gram))).alias("sizes")).first()
    sizes, longest = sorted(s for s in facts["sizes"] if s), facts["longest"] or 1
    if not sizes:
        return texts.select(*keys, F.lit("").alias("group"), F.lit(0).cast("bigint").alias("hits")).limit(0)
    piece = max(PIECE, longest)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    # A piece goes on into the next one as far as a term can.
    cut = texts.select(*keys, pieces.alias("_pieces")).select(
        *keys, F.explode(F.transform("_pieces", lambda p, i: F.concat(p, F.left(F.coalesce(F.get("_pieces", i + 1), F.lit("")), F.lit(longest - 1))))).alias("_piece")
    )
    placed = cut.select(*keys, "_piece", F.explode(F.sequence(F.lit(1), F.length("_piece"))).alias("_at"))
    looked = placed.select(*keys, "_piece", F.explode(F.array(*(F.substring("_piece", F.col("_at"), F.lit(size)) for size in sizes))).alias("gram"))
    found = looked.join(anchored(terms, gram), "gram").filter(F.col("_piece").contains(F.col("term")))
    return found.select(*keys, "group", "term").distinct().groupBy(*keys, "group").agg(F.count(F.lit(1)).alias("hits"))
