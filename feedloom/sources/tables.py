"""Tables kept between runs as Parquet in any file system Spark reads: dated tables, and keyed state.

Keyed state is cut into buckets by a hash of its key. A version is a small manifest that names the folder of each
bucket, so an update reads and writes the buckets it touches only, and a reader sees one whole version or the next.
The last few versions stay readable; folders that none of them names are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

STATE_KEY = "source_key"
STATE_BUCKETS = 64
#: Versions that stay readable beside the newest: a repeated batch starts from the one before.
KEPT_VERSIONS = 2
_MANIFESTS, _DATA, _BUCKET = "manifests", "data", "bucket"


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet table, or no rows while it does not exist yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


# ---- keyed state ----------------------------------------------------------------------------------------------


def state_versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _names(spark, f"{path}/{_MANIFESTS}") if n.endswith(".json")]


def _manifest(spark: SparkSession, path: str, before: int | None) -> dict:
    """{"buckets": how many, "folders": {bucket: folder}} of the newest version, or of the newest one below ``before``."""
    versions = [v for v in state_versions(spark, path) if before is None or v < before]
    if not versions:
        return {"buckets": STATE_BUCKETS, "folders": {}}
    fs, file = _file_system(spark, f"{path}/{_MANIFESTS}/{versions[-1]:020d}.json")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _put_manifest(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Written aside, then renamed: a manifest is there as a whole or not at all."""
    fs, aside = _file_system(spark, f"{path}/{_MANIFESTS}/_{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(json.dumps(manifest), "utf-8"))
    stream.close()
    _, file = _file_system(spark, f"{path}/{_MANIFESTS}/{version:020d}.json")
    fs.delete(file, False)
    if not fs.rename(aside, file):
        raise RuntimeError(f"could not write version {version} of {path}")


def _expire(spark: SparkSession, path: str, newest: int) -> None:
    """Remove manifests older than the kept ones, and folders that no manifest names any more."""
    kept = [v for v in state_versions(spark, path) if v <= newest][-1 - KEPT_VERSIONS :]
    for version in state_versions(spark, path):
        if version < kept[0]:
            fs, file = _file_system(spark, f"{path}/{_MANIFESTS}/{version:020d}.json")
            fs.delete(file, False)
    named = {f for v in state_versions(spark, path) for f in _manifest(spark, path, v + 1)["folders"].values()}
    for write in _names(spark, f"{path}/{_DATA}"):
        for bucket in _names(spark, f"{path}/{_DATA}/{write}"):
            if bucket.startswith(f"{_BUCKET}=") and f"{write}/{bucket}" not in named:
                fs, folder = _file_system(spark, f"{path}/{_DATA}/{write}/{bucket}")
                fs.delete(folder, True)
        if not any(n.startswith(f"{_BUCKET}=") for n in _names(spark, f"{path}/{_DATA}/{write}")):
            fs, folder = _file_system(spark, f"{path}/{_DATA}/{write}")
            fs.delete(folder, True)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _read_folders(spark: SparkSession, path: str, schema: str, folders: Iterable[str]) -> DataFrame:
    paths = [f"{path}/{_DATA}/{f}" for f in sorted(folders)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_state(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Newest version of a state table, or the newest one below ``before``."""
    return _read_folders(spark, path, schema, _manifest(spark, path, before)["folders"].values())


def update_state(
    changes: DataFrame, path: str, schema: str, merge: Callable[[DataFrame, DataFrame], DataFrame], version: int | None = None, key: str = STATE_KEY
) -> int:
    """Write the next version: ``merge(old, changes)`` for the buckets that keys of ``changes`` are in; returns the version.

    ``old`` has the rows of those buckets only, and no other bucket is read or written. Given a ``version``, the
    state below it is the base, so a repeated version gives the same state. ``changes`` is read twice: stage it first
    where that is dear. One writer at a time.
    """
    spark = changes.sparkSession
    known = state_versions(spark, path)
    number = version if version is not None else (known[-1] + 1 if known else 0)
    manifest = _manifest(spark, path, number)
    buckets, folders = manifest["buckets"], manifest["folders"]
    # At most as many numbers as there are buckets.
    touched = {str(r.b) for r in changes.select(_bucket(key, buckets).alias("b")).distinct().collect()}
    old = _read_folders(spark, path, schema, (f for b, f in folders.items() if b in touched))
    write = f"{number:020d}-{uuid.uuid4().hex}"
    new = merge(old, changes).withColumn(_BUCKET, _bucket(key, buckets))
    if touched:
        # Few files for a small bucket, several tasks for a crowded one.
        new.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{_DATA}/{write}")
    written = {n.removeprefix(f"{_BUCKET}="): f"{write}/{n}" for n in _names(spark, f"{path}/{_DATA}/{write}") if n.startswith(f"{_BUCKET}=")}
    kept = {b: f for b, f in folders.items() if b not in touched}
    _put_manifest(spark, path, number, {"buckets": buckets, "folders": kept | written})
    _expire(spark, path, number)
    return number


# ---- dated tables ---------------------------------------------------------------------------------------------


def write_dates(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Replace the given dates of a table partitioned by ``brief_date``, leave all others.

    Rebalanced first: few files for a quiet date, several tasks for a crowded one.
    """
    writer = df.hint("rebalance", "brief_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("brief_date").format(form).save(path)


def latest_row(df: DataFrame) -> DataFrame:
    """The row of the newest ``brief_date``: the "latest" copy of a dated table."""
    return df.orderBy(df["brief_date"].desc()).limit(1)
