"""Incremental staging of the disruption feed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.plans.disruptions import stage_disruptions
from kerbside.sources.published import PublishedTable


def run_disruption_staging(
    raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Merge every micro-batch of raw disruptions into the staged table, a :class:`PublishedTable`.

    Files may come in any order, so rows are merged by key and none is left out for its age or for having
    no time. A repeated batch is known by its name and changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        PublishedTable(batch.sparkSession, path).merge(
            stage_disruptions(batch),
            ["disruption_id", "ingest_ts"],
            [F.asc_nulls_last("last_update"), F.asc("title")],
            load_id=f"{query}:{batch_id}",
            cluster_by=["severity", "disruption_id"],
        )

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 minutes"}))
        .start()
    )
