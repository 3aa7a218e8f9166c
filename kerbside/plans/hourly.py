"""Hourly availability and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.fixed_values import CIVIL_ZONE, COVERAGE_THRESHOLD
from kerbside.functions import civil_time, hour_bucket, safe_divide
from kerbside.operators.prefix import running_max


def snapshot_totals(status: DataFrame, tz: str | None = None) -> DataFrame:
    """Network totals of every snapshot.

    The exact distinct count makes Spark pre-aggregate by snapshot and station, which also
    spreads a snapshot that holds most rows over all tasks.
    """
    return status.groupBy(
        "ingest_ts", hour_bucket(F.coalesce("event_ts", "ingest_ts"), tz).alias("hour_ts")
    ).agg(
        F.count_distinct("station_id").alias("stations_reporting"),
        F.sum("num_bikes_available").alias("total_bikes"),
        F.sum("num_docks_available").alias("total_docks"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_stations"),
    )


def hourly_totals(snapshots: DataFrame) -> DataFrame:
    """Snapshot totals rolled up to hours, with the largest average station count so far.

    The running maximum is taken over finished hours, as a prefix scan over their months.
    """
    hours = snapshots.groupBy("hour_ts").agg(
        F.avg("total_bikes").alias("avg_total_bikes_available"),
        F.max("total_bikes").alias("peak_total_bikes_available"),
        F.min("total_bikes").alias("min_total_bikes_available"),
        F.avg("total_docks").alias("avg_total_docks_available"),
        F.avg("stations_reporting").alias("avg_stations_reporting"),
        F.avg("empty_stations").alias("avg_empty_stations"),
        F.max("empty_stations").alias("peak_empty_stations"),
        F.count(F.lit(1)).alias("snapshot_samples"),
    )
    return running_max(hours, "hour_ts", "avg_stations_reporting", "total_stations_known")


def with_coverage(hourly: DataFrame, tz: str = CIVIL_ZONE, suffix: str = "local") -> DataFrame:
    """Adds the civil hour and the share of known stations that reported."""
    return hourly.withColumn(f"hour_{suffix}", civil_time("hour_ts", tz)).withColumn(
        "avg_coverage_ratio", safe_divide("avg_stations_reporting", "total_stations_known")
    )


def well_covered(
    hourly: DataFrame, tz: str = CIVIL_ZONE, min_ratio: float = COVERAGE_THRESHOLD, suffix: str = "local"
) -> DataFrame:
    """Hours with enough coverage for charts, with civil date and hour of day."""
    local = F.col(f"hour_{suffix}")
    return (
        with_coverage(hourly, tz, suffix)
        .filter(F.col("avg_coverage_ratio") >= min_ratio)
        .withColumn(f"date_{suffix}", F.to_date(local))
        .withColumn(f"hour_of_day_{suffix}", F.hour(local))
    )
