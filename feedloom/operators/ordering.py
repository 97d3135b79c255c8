"""The one order all jobs share: candidates, then live items by source and feed position, and so on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CANDIDATE, LIVE, CACHE, ARCHIVE = 0, 1, 2, 3
_ITEM_BITS = 40


def article_seq(origin: int, source_pos: Column, item_pos: Column) -> Column:
    """Sortable number: origin, then source position (below 2^20), then item position (below 2^40).

    A position out of its range stops the job: it would run into the bits of another.
    """
    source, item = source_pos.cast("bigint"), item_pos.cast("bigint")
    fits = source.between(0, 2 ** (60 - _ITEM_BITS) - 1) & item.between(0, 2**_ITEM_BITS - 1)
    wrong = F.raise_error(F.concat_ws(" ", F.lit("position out of range:"), source.cast("string"), item.cast("string")))
    number = F.lit(origin * 2**60).cast("bigint") + source * F.lit(2**_ITEM_BITS) + item
    return F.when(F.coalesce(fits, F.lit(True)), number).otherwise(wrong.cast("bigint")).alias("seq")


def item_position(seq: Column) -> Column:
    """Position of the item within its source."""
    return seq.bitwiseAND(F.lit(2**_ITEM_BITS - 1)).cast("bigint")
