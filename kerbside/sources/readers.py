"""Batch and streaming inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, as text, so that malformed lines reach the dead letters."""
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same lines from a folder that keeps receiving files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Lines from a message queue (needs Spark's Kafka package and a broker).

    Bytes are only re-labelled as text here; invalid UTF-8 is dead-lettered by the parser
    instead of failing the query.
    """
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reference table from CSV with declared types (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reads; nothing is listed or read."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_for_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose counts, minima and maxima are answered from the files' footers.

    They must be global or by partition columns, over numbers or dates; Parquet keeps no order for instants
    of the old kind, so times are asked for as whole microseconds. The frame lives in a session of its own,
    since the reader that can do this is chosen by setting.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session.read.parquet(path)
