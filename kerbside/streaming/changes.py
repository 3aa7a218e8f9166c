"""Station state with timers: changed rows only, and the stations that fell silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from kerbside.operators.latest import latest_by

#: Timers and value state need this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGED, SILENT = "changed", "silent"
_ORDER = ["event_us", "ingest_us", "tie"]


class _Changes(StatefulProcessor):
    """Keeps the order of each station's newest reading; a timer fires when no newer one comes."""

    def __init__(self, columns: list[str], silent_after_ms: int):
        self.columns, self.silent_after_ms = columns, silent_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "event_us bigint, ingest_us bigint, tie bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a station mostly has few readings, so plain tuples cost far less than frames
        order, best = None, None
        for part in rows:
            orders = list(zip(*(part[c].tolist() for c in _ORDER), strict=True))
            if orders and (order is None or max(orders) > order):
                order = max(orders)
                best = part.iloc[orders.index(order)]
        if best is None or (self.newest.exists() and order <= tuple(self.newest.get())):
            return
        self.newest.update(order)
        for old in self.handle.listTimers():
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(best["seen_ms"]) + self.silent_after_ms)
        row = {"station_id": [best["station_id"]], "kind": [CHANGED], "since_ms": [int(best["seen_ms"])]}
        yield pd.DataFrame(row | {c: [best[c]] for c in self.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since = expiredTimerInfo.getExpiryTimeInMs() - self.silent_after_ms
        row = {"station_id": [key[0]], "kind": [SILENT], "since_ms": [since]}
        yield pd.DataFrame(row | {c: [None] for c in self.columns})

    def close(self) -> None:
        pass


def station_changes(
    status: DataFrame, tie_break: str, silent_after: str = "1 day", watermark: str = "1 hour"
) -> DataFrame:
    """(station_id, kind, since_ms, reading): a row for each reading that became a station's newest.

    A station whose newest reading lies ``silent_after`` behind the watermark gives one ``silent`` row; it
    gives a ``changed`` row again when it comes back. Readings behind the watermark are dropped, as Spark
    does; a reading without an event time is as old as its snapshot but loses against any with one, as in the
    batch view. The reading travels as JSON, NULL members included.
    """
    spark = status.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    seen = F.coalesce("event_ts", "ingest_ts").cast("timestamp")
    reading = F.to_json(F.struct(*[F.col(c) for c in status.columns]), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    micros = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(-(1 << 62)))
    timed = status.select(
        "station_id", reading.alias("reading"), seen.alias("seen_at"), F.unix_millis(seen).alias("seen_ms"),
        micros("event_ts").alias("event_us"), micros("ingest_ts").alias("ingest_us"), F.col(tie_break).cast("bigint").alias("tie"),
    ).withWatermark("seen_at", watermark)
    after = int(pd.Timedelta(silent_after).total_seconds() * 1000)
    return timed.groupBy("station_id").transformWithStateInPandas(
        _Changes(["reading"], after), "station_id string, kind string, since_ms bigint, reading string", "Append", "EventTime"
    )


def run_station_changes(
    status: DataFrame, path: str, checkpoint: str, tie_break: str, silent_after: str = "1 day",
    watermark: str = "1 hour", trigger: dict | None = None,
) -> StreamingQuery:
    """Append the changes to a table, one partition a batch, which a repeat writes again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        station_changes(status, tie_break, silent_after, watermark)
        .writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All changes with their readings as columns; ``batch_id`` orders them."""
    rows = spark.read.schema("batch_id bigint, station_id string, kind string, since_ms bigint, reading string").parquet(path)
    return rows.withColumn("reading", F.from_json("reading", schema))


def state_of_changes(changes: DataFrame) -> DataFrame:
    """Newest reading of every station."""
    newest = latest_by(changes.filter(F.col("kind") == CHANGED), ["station_id"], [F.desc("batch_id")])
    return newest.select("reading.*")


def silent_stations(changes: DataFrame) -> DataFrame:
    """(station_id, silent_since) of stations that have not come back."""
    last = latest_by(changes, ["station_id"], [F.desc("since_ms"), F.desc(F.col("kind") == SILENT)])
    return last.filter(F.col("kind") == SILENT).select("station_id", F.timestamp_millis("since_ms").alias("silent_since"))
