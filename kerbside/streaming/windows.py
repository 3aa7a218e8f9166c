"""Event-time windows that close, with a table for the rows that come after that.

Spark's append mode drops rows behind the watermark. Here every micro-batch splits its readings by the
watermark the batches before it have reached: readings of open windows are aggregated, readings of closed
ones go to the late table as they are. Sums of open windows, a few rows, are the only state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from kerbside.sources.readers import path_exists

SUMS = ("readings", "bikes_seen", "empty_readings")
_SUMS_OF_WINDOW = "window_start timestamp, window_end timestamp, readings bigint, bikes_seen bigint, empty_readings bigint"
_STATE = f"batch_id bigint, newest timestamp, {_SUMS_OF_WINDOW}"


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("readings"),
        F.sum("num_bikes_available").alias("bikes_seen"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_readings"),
    ]


def _windowed(status: DataFrame, window: str, slide: str | None) -> DataFrame:
    """One row per reading and window; readings without any time belong to none."""
    timed = status.withColumn("seen_at", F.coalesce("event_ts", "ingest_ts").cast("timestamp"))
    span = F.window("seen_at", window, slide) if slide else F.window("seen_at", window)
    return (
        timed.withColumn("_w", span)
        .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        .drop("_w")
    )


def windowed_totals(status: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Bikes and empty stations of every event-time window of a table."""
    return _windowed(status, window, slide).groupBy("window_start").agg(*_measures())


def close_batch(
    batch: DataFrame, batch_id: int, path: str, window: str, slide: str | None, delay: str
) -> None:
    """One micro-batch of :func:`run_closing_windows`."""
    spark = batch.sparkSession
    pairs = _windowed(batch, window, slide).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        before = _state(spark, path, batch_id)
        newest_before = before.agg(F.max("newest")).first()[0]
        horizon = F.lit(newest_before).cast("timestamp") - F.expr(f"interval {delay}")
        is_late = F.coalesce(F.col("window_end") <= horizon, F.lit(False))
        _overwrite(pairs.filter(is_late), f"{path}/late/batch_id={batch_id}")
        newest = pairs.agg(F.greatest(F.max("seen_at"), F.lit(newest_before).cast("timestamp"))).first()[0]
        fresh = pairs.filter(~is_late).groupBy("window_start", "window_end").agg(*_measures())
        known = before.filter("window_start is not null").select(fresh.columns)
        sums = fresh.unionByName(known).groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in SUMS])
        reached = F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}")
        done = F.coalesce(F.col("window_end") <= reached, F.lit(False))
        _overwrite(sums.filter(done), f"{path}/closed/batch_id={batch_id}")
        # one row without a window carries the newest time where no window is open
        clock = spark.createDataFrame([(None,) * 5], _SUMS_OF_WINDOW)
        left = sums.filter(~done).unionByName(clock)
        marked = left.select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(newest).cast("timestamp").alias("newest"), *fresh.columns)
        _overwrite(marked, f"{path}/open/slot={batch_id % 2}")
    finally:
        pairs.unpersist()


def run_closing_windows(
    status: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    window: str = "1 hour",
    slide: str | None = None,
    delay: str = "10 minutes",
) -> StreamingQuery:
    """Keep ``closed`` (a window once, when the newest reading is ``delay`` past its end) and ``late`` under ``path``.

    Both tables are partitioned by batch id and a repeated batch writes the same partitions again. The
    state lies in two folders in turn, so a repeat finds what the batch before it has left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        close_batch(batch, batch_id, path, window, slide, delay)

    return (
        status.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def _state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Open windows as the last batch (before ``below``) has left them; a few rows."""
    slots = [f"{path}/open/slot={i}" for i in (0, 1) if path_exists(spark, f"{path}/open/slot={i}/_SUCCESS")]
    if not slots:
        return spark.createDataFrame([], _STATE)
    rows = spark.read.schema(_STATE).parquet(*slots)
    if below is not None:
        rows = rows.filter(F.col("batch_id") < below)
    last = rows.agg(F.max("batch_id")).first()[0]
    return rows.filter(F.col("batch_id") == last).select(*[f.split()[0] for f in _STATE.split(", ")])


def closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """Windows as they were when they closed: written once, never changed."""
    return spark.read.parquet(f"{path}/closed").drop("batch_id")


def late_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings that came after their window had closed, with that window."""
    return spark.read.parquet(f"{path}/late").drop("batch_id")


def settled_totals(spark: SparkSession, path: str) -> DataFrame:
    """All windows with everything that has come, and whether they have closed."""
    late = late_readings(spark, path).groupBy("window_start", "window_end").agg(*_measures())
    still_open = _state(spark, path).filter("window_start is not null").select("window_start", *SUMS)
    parts = (
        closed_windows(spark, path).unionByName(late).select("window_start", *SUMS, F.lit(True).alias("closed"))
        .unionByName(still_open.withColumn("closed", F.lit(False)))
    )
    return parts.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in SUMS], F.bool_or("closed").alias("closed"))
