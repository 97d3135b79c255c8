"""Shards by K-d tree partitioning over document metadata.

Every document is a point: numbers are scaled to 0..1, names are laid on a line by their hash. The tree
starts with all documents and splits every node at the weighted median (by bytes) along the dimension in
which it is widest, until the leaves reach the target size. A node for an odd number of leaves is split in
that proportion.

All nodes of a level are split together. Medians are exact and distributed: rows of a few dozen bytes are
range-partitioned by node and coordinate, sizes are summed per segment, and a row goes left while the sum
up to its middle is below the left side's part. Ties on the coordinate follow the id, so a value that a
third of all documents share is split like any other. Texts are read once, for their sizes and checksums.

Defined results: a null text counts as empty, a null in a dimension lies at 0, a null id comes first.
Repeated rows each get a row. Fewer documents than shards leave shards empty; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.llm.common import text_or_empty
from feedloom.operators.segments import add_rank, cut_segments
from feedloom.operators.stage import staged

#: One row of some 100 bytes per node is sent to the executors.
MAX_SHARDS = 1 << 16


def byte_size(text_col: str = "text") -> Column:
    return (F.octet_length(text_or_empty(text_col)) + 1).cast("bigint")


def named(column: Column) -> Column:
    """A name's place on the line 0..1."""
    return F.when(column.isNull(), F.lit(0.0)).otherwise(F.pmod(F.xxhash64(column), F.lit(1 << 32)) / float(1 << 32))


def document_dimensions(text_col: str = "text") -> dict[str, Column]:
    """Source, language and order of magnitude of the length (40 doublings are 1)."""
    length = F.log2(byte_size(text_col).cast("double")) / 40.0
    return {"source": named(F.col("source")), "lang": named(F.col("lang")), "length": length}


def with_shards(rows: DataFrame, dimensions: list[str], shards: int) -> DataFrame:
    """``rows`` (doc_id, size, tie, dimensions and others) with ``shard``, a leaf of the tree."""
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"shards must be from 1 to {MAX_SHARDS}")
    columns = rows.columns
    tree = rows.withColumn("shard", F.lit(0)).withColumn("_leaves", F.lit(shards))
    order = ["_at", "doc_id", "tie"]
    most = shards
    while most > 1:
        nodes = tree.groupBy("shard").agg(
            F.sum("size").alias("_bytes"), *(f(d).alias(f"_{f.__name__}_{d}") for d in dimensions for f in (F.min, F.max))
        )
        widths = [F.struct((F.col(f"_max_{d}") - F.col(f"_min_{d}")).alias("w"), F.lit(-i).alias("i")) for i, d in enumerate(dimensions)]
        widest = F.array_max(F.array(*widths))["i"]
        # One row per node, at most ``shards`` of them.
        nodes = F.broadcast(nodes.select("shard", "_bytes", (-widest).alias("_widest")))
        at = F.array(*(F.col(d).cast("double") for d in dimensions))[F.col("_widest")]
        cut = cut_segments(tree.join(nodes, "shard").withColumn("_at", at).drop("_widest"), ["shard"], order)
        sums = cut.groupBy("shard", "segment").agg(F.sum("size").alias("_sum"))
        earlier = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select("shard", "segment", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
        inside = Window.partitionBy("shard", "segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        before = cut.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["shard", "segment"])
        left = F.floor(F.col("_leaves") / 2).cast("int")
        middle = F.col("_start") + F.col("_inside") + F.col("size") / 2
        goes_left = middle * F.col("_leaves") <= F.col("_bytes") * left
        moved = before.withColumn("_left", left).withColumn("_goes", goes_left)
        tree = staged(
            moved.select(
                *columns,
                F.when(F.col("_goes") | (F.col("_leaves") == 1), F.col("shard")).otherwise(F.col("shard") + F.col("_left")).alias("shard"),
                F.when(F.col("_leaves") == 1, 1).when(F.col("_goes"), F.col("_left")).otherwise(F.col("_leaves") - F.col("_left")).alias("_leaves"),
            ),
            "kd-level",
        )
        most = -(-most // 2)
    return tree.select(*columns, "shard")


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; give the number of shards or the bytes of one."""
    dimensions = document_dimensions(text_col) if dimensions is None else dimensions
    names = [f"dim_{i}" for i in range(len(dimensions))]
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        byte_size(text_col).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("tie"),
        *(c.cast("double").alias(n) for n, c in zip(names, dimensions.values())),
    )
    rows = staged(rows, "kd-rows")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // max(1, target_bytes)))
    placed = with_shards(rows, names, shards)
    ranked = add_rank(placed.select("doc_id", "size", "text_crc32", "tie", "shard"), ["shard"], ["doc_id", "tie"], "_rank")
    return ranked.select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - 1).alias("slot"))
