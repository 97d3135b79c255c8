"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # A run compiles a few hundred small classes; the default of 100 would compile them again and again.
        "spark.sql.codegen.cache.maxEntries": "1000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates without a zone are UTC everywhere in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
