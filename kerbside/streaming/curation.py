"""Continuous curation: lines in, station rows and dead letters out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from kerbside.operators.events import dead_letters, route_snapshots, station_rows, with_dlq_counters
from kerbside.sources.sinks import in_pieces


def _write_batch(rows: DataFrame, path: str, ts: str, cluster_by: str, batch_id: int, long_rows: bool = False) -> None:
    """Write one micro-batch into its own partitions; a repeated batch replaces them.

    Long rows are dealt out by what they weigh uncompressed.
    """
    dated = rows.withColumn("ingest_date", F.to_date(ts)).withColumn("batch_id", F.lit(batch_id))
    (
        (in_pieces(dated, "ingest_date") if long_rows else dated.hint("rebalance", "ingest_date"))
        .sortWithinPartitions("batch_id", "ingest_date", cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "ingest_date")
        .parquet(path)
    )


def run_curation(
    lines: DataFrame,
    status_path: str,
    dlq_path: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Start the job; ``lines`` is a stream with a text column ``value``.

    Every micro-batch is routed once, kept while its two sinks are written, and released. Both
    sinks are partitioned by batch id and overwritten on retry, so a batch repeated after a
    failure leaves no duplicates. ``dlq_path`` may be None to drop dead letters. Per-stage
    counters appear in the query progress under ``dlq``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write_batch(station_rows(held), status_path, "ingest_ts", "station_id", batch_id)
            if dlq_path is not None:
                _write_batch(dead_letters(held), dlq_path, "dlq_ts", "stage", batch_id, long_rows=True)
        finally:
            held.unpersist()

    routed = with_dlq_counters(route_snapshots(lines, as_of))
    return (
        routed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
