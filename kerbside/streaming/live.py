"""Continuously maintained station state, enrichment and de-duplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.asof import join_as_of
from kerbside.sources.published import PublishedTable
from kerbside.sources.seen import SeenIds


def latest_state_stream(status: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Newest row of every station as a streaming aggregation: the state is one row per station.

    A missing event time sorts before any known one, as in the batch view.
    """
    order = F.struct(*[F.col(c) for c in ("event_ts", "ingest_ts", *(tie_break or []))])
    row = F.struct(*[F.col(c) for c in status.columns if c != "station_id"])
    newest = status.groupBy("station_id").agg(F.max_by(row, order).alias("row"))
    return newest.select("station_id", "row.*")


def run_live_state(
    status: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    tie_break: list[str] | None = None,
    keep_versions: int = 2,
) -> StreamingQuery:
    """Publish the state table, a :class:`PublishedTable`, anew after every micro-batch.

    A micro-batch brings the stations that changed; the others are taken over from the version before. A
    repeated batch is known by its name and changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = PublishedTable(spark, path, keep_versions=keep_versions)
        last, rows = table.read(), batch
        if last is not None:
            rows = last.join(batch.select("station_id"), "station_id", "left_anti").unionByName(batch)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.replace(rows, load_id=f"{query}:{batch_id}")

    return (
        latest_state_stream(status, tie_break)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_live_state(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest version."""
    return PublishedTable(spark, path).read()


def run_append(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def enrich_stream(status: DataFrame, information: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add station metadata to a status stream. ``information``: one current row per station."""
    wanted = columns or ["name", "lat", "lon", "capacity"]
    return status.join(information.select("station_id", *wanted), "station_id", "left")


def run_enrichment_as_of(
    status: DataFrame,
    versions: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    columns: list[str],
    trigger: dict | None = None,
    valid_from: str = "valid_from",
) -> StreamingQuery:
    """Write each reading with the metadata valid at its own time; ``versions`` is read anew for every batch.

    A repeated batch replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("seen_at", F.coalesce("event_ts", "ingest_ts"))
        rows = join_as_of(timed, versions(), ["station_id"], "seen_at", valid_from, columns).drop("seen_at")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        status.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def run_deduplicated(
    messages: DataFrame, index_path: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write every message id once, however late it is delivered again: :class:`SeenIds` remembers them all.

    A repeated batch replaces its folder and its entries.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        fresh = SeenIds(batch.sparkSession, index_path).fresh(batch, f"{query}-{batch_id}")
        fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def deduplicate_stream(messages: DataFrame, ts: str = "publish_time", watermark: str = "1 hour") -> DataFrame:
    """Drop redelivered messages that arrive within the watermark."""
    return messages.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["message_id"])


__all__: list[str] = [
    "deduplicate_stream",
    "enrich_stream",
    "latest_state_stream",
    "read_live_state",
    "run_append",
    "run_deduplicated",
    "run_enrichment_as_of",
    "run_live_state",
]
