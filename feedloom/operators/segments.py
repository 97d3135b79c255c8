"""Running computations over long ordered groups, cut into segments of bounded size.

A window over one group runs in one task. Where a group may hold a large share of all rows, the
rows are range-partitioned by group *and* order first, so a long group spans many partitions. Each
segment (group, partition) is computed by itself; what it passes on to later segments of its group
is one small row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.operators.stage import staged


def cut_segments(rows: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """Add ``segment``: segments of a group follow its order. Written once, so the cut is stable."""
    ranged = rows.repartitionByRange(*by, *order) if by else rows.repartitionByRange(*order)
    return staged(ranged.withColumn("segment", F.spark_partition_id()), "segments")


def add_rank(rows: DataFrame, by: list[str], order: list[Column | str], name: str = "rank") -> DataFrame:
    """Position 1, 2, ... of every row in its group. ``order`` must leave no ties.

    Exact for groups of any size: position inside the segment plus the sizes of the segments before.
    """
    cut = cut_segments(rows, by, order)
    keys = [*by, "segment"]
    sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    ranked = cut.withColumn("_inside", F.row_number().over(inside)).join(starts, keys)
    return ranked.withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint")).drop("_start", "_inside", "segment")


def top_rows(rows: DataFrame, by: list[str], order: list[Column | str], limit: int, name: str = "pos") -> DataFrame:
    """The first ``limit`` rows of every group with their position.

    Spark cuts every input partition to ``limit`` rows per group before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)
