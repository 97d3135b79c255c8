"""What the operators of this package share: reading documents, Arrow batches, byte pieces of long texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: White space of the word definition, for regular expressions in Spark and in DuckDB.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
PIECE_BYTES = 1 << 20
SLICE_BYTES = 1 << 23


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def join_shuffled(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join for which both sides are shuffled, whatever size the planner takes them for.

    It sees neither the rows that an explode makes nor those that a packed Parquet file holds, and what it broadcasts for
    that has to fit the driver. Large partitions of such a join can be split like any other's.
    """
    return left.join(right.hint("merge"), on, how)


def map_arrow(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` of a function of one batch; None adds nothing.

    Batches are cut to some ``SLICE_BYTES``, so that what a function holds at once is bounded by that and its
    longest row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                out = per_batch(batch.slice(at, rows))
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, nulls as empty texts."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Parts of a text that end at white space, so that no word is cut; a longer word stays whole."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while cut < len(text) and text[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]
