"""Cutting lineage with a table written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-"))
    return spark.sparkContext.getCheckpointDir()


_open_scratches: list[list[str]] = []


def fresh_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open_scratches:
        _open_scratches[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders taken inside are removed at the end: nothing that reads them may be used later."""
    own: list[str] = []
    _open_scratches.append(own)
    try:
        yield
    finally:
        _open_scratches.remove(own)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in own:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: survives lost executors and gives the planner real sizes."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``staged`` with the number of rows, counted while they are written."""
    seen = Observation()
    table = staged(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return table, seen.get["n"]


def spread_single(df: DataFrame, key: str) -> DataFrame:
    """Spread a table that its scan reads as one task, so at most one split (128 MB by default), over all cores."""
    if df.rdd.getNumPartitions() > 1:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
