"""Operational probes and dashboard figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import fixed_values as fx
from kerbside.functions import minutes_between, safe_divide


def freshness(df: DataFrame, as_of: Column) -> DataFrame:
    """Newest ingest time and its age in whole minutes."""
    return df.agg(F.max("ingest_ts").alias("last_ingest")).withColumn(
        "lag_minutes", minutes_between("last_ingest", as_of)
    )


def raw_flow(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("ingest_ts").alias("first_ingest"),
        F.max("ingest_ts").alias("last_ingest"),
    )


def flow_from_footers(footers: DataFrame, micros: str, as_of: Column) -> DataFrame:
    """Rows, oldest and newest time and its age, of a table with times as microseconds in ``micros``.

    ``footers`` comes from :func:`~kerbside.sources.read_for_footers`; no column is read for it.
    """
    found = footers.agg(F.count(F.lit(1)).alias("row_count"), F.min(micros).alias("_first"), F.max(micros).alias("_last"))
    first, last = (F.timestamp_micros(c).cast("timestamp_ntz") for c in ("_first", "_last"))
    flow = found.select("row_count", first.alias("first_ingest"), last.alias("last_ingest"))
    return flow.withColumn("lag_minutes", minutes_between("last_ingest", as_of))


def daily_flow_from_footers(footers: DataFrame, micros: str, day: str = "ingest_date") -> DataFrame:
    """Rows and newest time of every day of a day-partitioned table, from its footers alone."""
    per_day = footers.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"), F.max(micros).alias("_last"))
    return per_day.select(day, "row_count", F.timestamp_micros("_last").cast("timestamp_ntz").alias("last_ingest"))


def poll_counts(staged: DataFrame) -> DataFrame:
    return staged.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("ingest_ts").alias("distinct_polls")
    )


def distinct_stations(information: DataFrame) -> DataFrame:
    return information.agg(F.count_distinct("station_id").alias("total_stations"))


def daily_stations(information: DataFrame, days: int = 7) -> DataFrame:
    """Distinct stations per ingest day, newest days first."""
    per_day = information.groupBy(F.to_date("ingest_ts").alias("ingest_date")).agg(
        F.count_distinct("station_id").alias("stations_count")
    )
    return per_day.orderBy(F.desc("ingest_date")).limit(days)


def history_size(history: DataFrame) -> DataFrame:
    """Rows of the history against rows of the latest-state table (one per station)."""
    per_station = history.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))
    return per_station.agg(F.sum("n").alias("history_rows"), F.count(F.lit(1)).alias("latest_rows"))


def inspect_dead_letters(
    dlq: DataFrame, stage: str | None = None, message_like: str | None = None, n: int = 10, width: int = 100
) -> DataFrame:
    """Newest dead letters of a stage or message pattern, messages shortened for display."""
    found = dlq
    if stage:
        found = found.filter(F.col("stage") == stage)
    if message_like:
        found = found.filter(F.col("error_message").like(message_like))
    return (
        found.select(
            "dlq_ts", "stage", "error_type", F.substr("error_message", F.lit(1), F.lit(width)).alias("error_msg"), "raw"
        )
        .orderBy(F.desc("dlq_ts"), "stage", "error_type", "error_msg", "raw")
        .limit(n)
    )


def original_publish_time(push_dlq: DataFrame) -> DataFrame:
    """When a dead-lettered message was first published, from its attributes."""
    return push_dlq.select(
        "message_id",
        F.try_to_timestamp(F.col("attributes")[fx.ORIGINAL_PUBLISH_TIME_ATTRIBUTE]).alias("original_publish_time"),
    )


def live_kpis(state: DataFrame) -> DataFrame:
    """Bikes, docks and stations right now."""
    return state.agg(
        F.sum("mechanical_available").alias("total_mechanical"),
        F.sum("ebike_available").alias("total_ebikes"),
        F.sum("num_docks_available").alias("total_docks"),
        F.count(F.lit(1)).alias("stations_reporting"),
    )


def availability_trend(covered: DataFrame) -> DataFrame:
    return covered.select(
        "hour_local", "avg_total_bikes_available", "peak_total_bikes_available", "min_total_bikes_available"
    )


def empty_station_trend(covered: DataFrame) -> DataFrame:
    return covered.select(
        "hour_local", "avg_empty_stations", "peak_empty_stations", "avg_stations_reporting", "avg_coverage_ratio"
    )


def active_by_severity(latest: DataFrame) -> DataFrame:
    return latest.groupBy("severity").agg(F.count(F.lit(1)).alias("disruptions"))


def disruption_timeline(staged: DataFrame) -> DataFrame:
    """Distinct disruptions seen per hour and severity."""
    return staged.groupBy(F.date_trunc("hour", "ingest_ts").alias("hour_ts"), "severity").agg(
        F.count_distinct("disruption_id").alias("disruptions")
    )


def temporal_baseline(status: DataFrame) -> DataFrame:
    """Usual bikes of a station at an hour of a weekday (1 = Sunday)."""
    ts = F.coalesce("event_ts", "ingest_ts")
    return status.groupBy(
        "station_id", F.dayofweek(ts).alias("weekday"), F.hour(ts).alias("hour_of_day")
    ).agg(
        F.avg("num_bikes_available").alias("usual_bikes"),
        F.count(F.lit(1)).alias("samples"),
    )


def hourly_depletion(status: DataFrame, tie_break: str) -> DataFrame:
    """Net bikes lost per station and hour between its first and last reading of the hour.

    Two extremes per group are enough: no window over a station's whole history.
    """
    ts = F.coalesce("event_ts", "ingest_ts")
    reading = F.struct(ts.alias("ts"), F.col(tie_break), F.col("num_bikes_available").alias("bikes"))
    per_hour = status.groupBy("station_id", F.date_trunc("hour", ts).alias("hour_ts")).agg(
        F.min(reading).alias("first"), F.max(reading).alias("last"), F.count(F.lit(1)).alias("readings")
    )
    return per_hour.select(
        "station_id", "hour_ts", "readings", (F.col("first.bikes") - F.col("last.bikes")).alias("bikes_lost")
    )


def availability_by_post_code(facts: DataFrame) -> DataFrame:
    """Live availability per postal district."""
    return facts.groupBy("post_code").agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum("num_bikes_available").alias("bikes"),
        F.round(safe_divide(F.sum("num_bikes_available") * 100, F.sum("capacity")), 1).alias("fill_pct"),
    )
