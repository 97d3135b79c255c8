"""Mixing sources to target weights.

Every source has a budget of words: its share of the mix by weight, at most ``max_epochs`` times its size;
what a source can't take is shared by weight among the others until none is above. A budget is whole epochs
of the source and a rest. For the rest, documents have hash-random keys; keys are range-sorted within each
source, sizes summed up in that order by distributed prefix sums, and the source is cut where the sum
reaches the rest. What a document gives then depends on its source's cut and its own key only, so texts are
neither sorted nor shuffled; the mix is a row-local step over them.

The document at the cut gives its first words up to the exact budget. Rows of equal key (the same id) meet
the cut together and give the same share of their words.

Defined results: a null or empty text has size 0 and is in no mix; a null source is a source of its own,
the last in order; an empty table gives an empty mix; sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.llm.common import SPACE, WORD, join_shuffled, text_or_empty
from feedloom.operators.segments import cut_segments
from feedloom.operators.stage import staged, staged_counted

MIX_SHARE = 1.5
MAX_EPOCHS = 2
WEIGHTS = (3, 1, 2)
SEED = 7
#: Cuts of so many sources, some hundred bytes each, are sent to all executors; more are joined.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def mix_key(doc_id: Column, seed: int = SEED) -> Column:
    """Hash-random and the same in every run: 128 bits as hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def weights_in_turn(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources in order of code points, null last, weigh ``weights`` in turn; one row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return totals.withColumn("weight", F.array(*map(F.lit, weights))[F.pmod(place, F.lit(len(weights)))])


def source_targets(totals: DataFrame, share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``totals`` (source, source_size, weight) with ``target``, in words.

    A source is at its limit, or has its weight times one level that is the same for all others. In order of
    limit over weight, the level is what is left for the sources from there on over their weights, at the
    first source where that is not above its limit. Runs over one row per source.
    """
    order = Window.orderBy("_full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * max_epochs
    ranked = totals.withColumn("_full_at", limit / F.col("weight"))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum(limit).over(before), F.lit(0))
    levels = ranked.withColumn("_level", left / F.sum("weight").over(onward))
    level = F.min(F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "source", "_level"))).over(everything)
    found = levels.withColumn("_found", level["_level"])
    target = F.coalesce(F.least(limit.cast("double"), F.col("_found") * F.col("weight")), limit.cast("double"))
    return found.withColumn("target", target).drop("_full_at", "_level", "_found")


def source_cuts(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source what its documents need to know: epochs, cut key, and at the cut ``part`` of ``whole`` words.

    ``keyed`` has (source, key, size). Documents with a key below the cut give one epoch more; the budget is
    the target rounded to whole words.
    """
    plan = targets.withColumn("_budget", F.round("target").cast("bigint"))
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(0).cast("bigint"))
    plan = plan.withColumn("_rest", F.col("_budget") - F.col("epochs") * F.col("source_size"))
    groups = keyed.groupBy("source", "key").agg(F.sum("size").alias("size"))
    cut = cut_segments(groups, ["source"], ["key"])
    sums = cut.groupBy("source", "segment").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    # The cut lies in one segment of each source; only that one is summed row by row.
    crossing = (
        starts.withColumn("source", F.struct("source"))
        .join(plan.select(F.struct("source").alias("source"), "_rest"), "source")
        .filter((F.col("_start") <= F.col("_rest")) & (F.col("_rest") < F.col("_start") + F.col("_sum")))
        .select("source", "segment", "_start", "_rest")
    )
    # One row per source at most, counted: left to itself, the planner takes the documents for the smaller side.
    crossing, n = staged_counted(crossing, "mix-crossing")
    inside = Window.partitionBy("source", "segment").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    documents, keys = cut.withColumn("source", F.struct("source")), ["source", "segment"]
    placed = documents.join(F.broadcast(crossing), keys) if n <= BROADCAST_SOURCES else join_shuffled(documents, crossing, keys)
    placed = placed.withColumn("_before", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = placed.filter((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("size")))
    cuts = at.select("source", F.col("key").alias("cut_key"), (F.col("_rest") - F.col("_before")).alias("part"), F.col("size").alias("whole"))
    return (
        plan.withColumn("source", F.struct("source"))
        .join(cuts, "source", "left")
        .select("source.source", "source_size", "weight", "target", "epochs", "cut_key", "part", "whole")
    )


def last_epoch(size: Column, key: Column) -> Column:
    """Words that a document gives besides whole epochs, from the columns of its source's cut."""
    return (
        F.when(key < F.col("cut_key"), size)
        .when(key == F.col("cut_key"), F.floor(size * F.col("part") / F.col("whole")).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = MIX_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, key) of every row, and one row per source: target and cut. Texts are read once."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(text_or_empty(text_col)).alias("size"),
        mix_key(F.col(id_col), seed).alias("key"),
    )
    rows = staged(rows, "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(weights_in_turn(totals, weights), share, max_epochs), "mix-targets")
    return rows, source_cuts(rows, targets)


def with_cuts(rows: DataFrame, cuts: DataFrame, source_col: str = "source") -> DataFrame:
    """``rows`` with the columns of their source's cut as struct ``_cut``."""
    table, n = staged_counted(cuts.select(F.struct("source").alias("_source"), F.struct(*cuts.columns).alias("_cut")), "mix-cuts")
    keyed = rows.withColumn("_source", F.struct(F.col(source_col).alias("source")))
    return keyed.join(F.broadcast(table) if n <= BROADCAST_SOURCES else table, "_source").drop("_source")


def taken_words(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``mix_plan``."""
    cut = with_cuts(rows, cuts).select("doc_id", "source", "size", "key", "_cut.source_size", "_cut.target", "_cut.epochs", "_cut.cut_key", "_cut.part", "_cut.whole")
    taken = F.col("epochs") * F.col("size") + last_epoch(F.col("size"), F.col("key"))
    return cut.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[{SPACE}]*{WORD}"), F.lit(0)), 1, n.cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: a row per epoch of a document, with the columns of ``docs``; the text at a cut ends there."""
    seed = options.get("seed", SEED)
    _, cuts = mix_plan(docs, id_col, text_col, source_col, **options)
    keyed = with_cuts(docs, cuts, source_col)
    size = word_count(text_or_empty(text_col))
    key = mix_key(F.col(id_col), seed)
    below, at = key < F.col("_cut.cut_key"), key == F.col("_cut.cut_key")
    part = F.floor(size * F.col("_cut.part") / F.col("_cut.whole")).cast("bigint")
    # Words of each copy: null stands for all of them.
    whole = F.array_repeat(F.lit(None).cast("bigint"), F.col("_cut.epochs").cast("int"))
    rest = F.when(F.coalesce(below, F.lit(False)), F.array(F.lit(None).cast("bigint"))).when(at & (part > 0), F.array(part)).otherwise(F.array().cast("array<bigint>"))
    empty = ~F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    copies = keyed.withColumn("_words", F.explode(F.when(empty, F.array().cast("array<bigint>")).otherwise(F.concat(whole, rest))))
    cut_text = F.when(F.col("_words").isNull(), F.col(text_col)).otherwise(first_words(F.col(text_col), F.col("_words")))
    return copies.select(*(cut_text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
