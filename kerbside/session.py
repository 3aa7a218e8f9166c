"""Session settings and staging of intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the results or the skew handling depend on. Spark decides about broadcast
# joins from measured sizes against spark.sql.autoBroadcastJoinThreshold and falls back to a
# shuffled join beyond it; only the text operators force some, of sides bounded by a parameter.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for name, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "kerbside", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**REQUIRED_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the cluster names in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="kerbside-staging-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage, so that a result with several consumers is computed once and a lost
    executor re-reads files instead of recomputing history. Parquet keeps column pruning,
    filter pushdown and true size statistics for the joins that follow.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/kerbside/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes begun in here remove their shuffle files when they end, not when the driver collects garbage.

    For results that are read from what was written, never from the plan that wrote them.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
