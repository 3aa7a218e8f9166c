"""Current state of the station network."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.latest import latest_by


def _newest(tie_break: Sequence[Column]) -> list[Column]:
    return [F.desc_nulls_last("event_ts"), F.desc_nulls_last("ingest_ts"), *tie_break]


def latest_state(status: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Newest status row of every station."""
    return latest_by(status, ["station_id"], _newest(tie_break))


def latest_information(information: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Newest metadata row of every station."""
    return latest_by(information, ["station_id"], _newest(tie_break))


def enrich(state: DataFrame, information: DataFrame) -> DataFrame:
    """State rows with the metadata of their station, NULL where it is unknown."""
    wanted = [c for c in ("station_id", "name", "lat", "lon", "capacity", "address") if c in information.columns]
    return state.join(information.select(*wanted), "station_id", "left")


def station_facts(state: DataFrame, information: DataFrame) -> DataFrame:
    """One row per known station with its place and, where it reports, its live fill rate.

    ``has_fill`` marks stations that report and have a usable capacity: the ones that can be
    averaged or serve as control.
    """
    place = information.select(
        "station_id", "station_code", F.col("name").alias("station_name"), "lat", "lon",
        F.col("capacity").alias("station_capacity"),
    )
    live = state.select("station_id", "num_bikes_available", "num_docks_available", F.lit(True).alias("reports"))
    has_fill = F.col("reports") & F.coalesce(F.col("station_capacity") > 0, F.lit(False))
    return (
        place.join(live, "station_id", "left")
        .withColumn("reports", F.coalesce("reports", F.lit(False)))
        .withColumn("has_fill", has_fill)
        .withColumn(
            "fill_rate",
            F.when(F.col("has_fill"), F.try_divide(F.col("num_bikes_available"), F.col("station_capacity"))),
        )
    )
