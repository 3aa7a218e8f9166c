"""Station metadata rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import is_truthy, json_list, json_text
from kerbside.sources.landing import push_outcomes


def flatten_station_info(
    messages: DataFrame, received_at: Column | None = None, drill_enabled: bool = False
) -> DataFrame:
    """Pushed metadata messages as one row per station with a non-blank id.

    ``received_at`` replaces a missing ingest time; a message with an unreadable time or number is not
    accepted at all, it is retried. Unlike in the status feed, a missing station code is the empty text.
    """
    event, station = F.col("event"), F.col("station")
    now = received_at if received_at is not None else F.current_timestamp()
    ingest_ts = F.when(is_truthy(event, "$.ingest_ts"), F.try_to_timestamp(json_text(event, "$.ingest_ts")))
    event_ts = F.when(is_truthy(event, "$.event_ts"), F.try_to_timestamp(json_text(event, "$.event_ts")))

    def number(name: str, kind: str) -> Column:
        return F.try_variant_get(station, f"$.{name}", kind)

    def either(first: str, second: str) -> Column:
        return F.when(is_truthy(station, f"$.{first}"), json_text(station, f"$.{first}")).otherwise(
            json_text(station, f"$.{second}")
        )

    code = F.when(
        is_truthy(station, "$.stationCode") | is_truthy(station, "$.station_code"),
        either("stationCode", "station_code"),
    ).otherwise("")
    return (
        push_outcomes(messages, drill_enabled)
        .filter(F.col("outcome") == "accepted")
        .withColumn("ingest_ts", F.coalesce(ingest_ts, now))
        .withColumn("event_ts", F.coalesce(event_ts, F.col("ingest_ts")))
        .select("ingest_ts", "event_ts", F.explode(json_list(event, "$.payload.data.stations")).alias("station"))
        .filter(F.trim(json_text(station, "$.station_id")) != "")
        .select(
            "ingest_ts",
            "event_ts",
            json_text(station, "$.station_id").alias("station_id"),
            code.alias("station_code"),
            json_text(station, "$.name").alias("name"),
            number("lat", "double").alias("lat"),
            number("lon", "double").alias("lon"),
            number("capacity", "bigint").alias("capacity"),
            json_text(station, "$.address").alias("address"),
            either("post_code", "postCode").alias("post_code"),
            F.to_json(station).alias("raw_station_json"),
        )
    )
