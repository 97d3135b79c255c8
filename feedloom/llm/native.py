"""Matches of regular expressions with their places, by DataFrame functions only.

Spark has no function for match positions. The gaps between matches (``split``) and the matches
(``regexp_extract_all``) of one pattern give them: a match starts after all gaps and matches before it.
Patterns must not match the empty string. Lengths count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EMPTY_SPANS = "array<struct<start:bigint,end:bigint,match:string>>"


#: Places are summed up in blocks of so many matches: work grows a little more than in proportion to the matches.
BLOCK = 128


def gaps_and_matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """array<struct<gap, match>> of all leftmost matches that don't overlap with the text before each; the text behind the last."""
    gaps, matches = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    return pairs, F.get(gaps, F.size(matches))


def spans_of_pairs(pairs: Column, empty: str = EMPTY_SPANS, *more: str) -> Column:
    """array<struct<start, end, match, more>> of pairs (gap, match, more): a match starts after all gaps and matches before it."""
    blocks = F.sequence(F.lit(0), F.ceil(F.size(pairs) / BLOCK).cast("int") - 1)
    block = lambda b: F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK))
    length = lambda pair: (F.length(pair["gap"]) + F.length(pair["match"])).cast("bigint")
    sizes = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0).cast("bigint"), lambda n, pair: n + length(pair)))

    def next_start(done: Column, size: Column) -> Column:
        return F.struct((done["at"] + size).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts"))

    zero = F.lit(0).cast("bigint")
    starts = F.aggregate(sizes, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts")), next_start, lambda done: done["starts"])

    def step(done: Column, pair: Column) -> Column:
        start = (done["at"] + F.length(pair["gap"])).cast("bigint")
        end = (start + F.length(pair["match"])).cast("bigint")
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"), *(pair[name].alias(name) for name in more))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def placed(start: Column, b: Column) -> Column:
        nothing = F.struct(start.alias("at"), F.array().cast(empty).alias("spans"))
        return F.aggregate(block(b), nothing, step, lambda done: done["spans"])

    return F.when(F.size(pairs) > 0, F.flatten(F.transform(starts, placed))).otherwise(F.array().cast(empty))


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all leftmost matches that don't overlap."""
    return spans_of_pairs(gaps_and_matches(text, pattern)[0])


def spans_where(wanted: Column, text: Column, pattern: str) -> Column:
    """``spans_of`` where a cheap test says that there can be matches, else no spans."""
    return F.when(wanted, spans_of(text, pattern)).otherwise(F.array().cast(EMPTY_SPANS))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined, of array<struct<start, rank, end, kind>>: by start, then rank of the kind."""
    ordered = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(ordered, ",")
