"""Hourly figures kept up to date: mergeable partials with exact distinct stations as bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions import hour_bucket
from kerbside.session import stage
from kerbside.sources.published import PublishedTable

KEYS = ["hour_ts", "ingest_ts", "block"]
SUMS = ["total_bikes", "total_docks", "empty_stations"]


class HourlyRollup:
    """Partials of every snapshot and hour under ``path``; a load changes the months of its hours only.

    Stations have numbers, given once and never changed. A partial holds the sums of a snapshot's readings
    in an hour and a bitmap of the stations in them, for each block of 32,768 numbers, so two partials
    of the same snapshot add up exactly, whichever came first. Loads are known by their names.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.partials = PublishedTable(spark, f"{path}/partials", ts="hour_ts")
        self.numbers = PublishedTable(spark, f"{path}/numbers", ts="since")

    def add(self, status: DataFrame, load_id: str) -> bool:
        """Add the readings of one file or batch; False if this load has been added before."""
        if self.partials.has_load(load_id):
            return False
        hour = hour_bucket(F.coalesce("event_ts", "ingest_ts")).alias("hour_ts")
        fresh = self._numbered(status).groupBy(
            hour, "ingest_ts", F.expr("bitmap_bucket_number(number)").alias("block")
        ).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("stations"),
            F.sum("num_bikes_available").alias("total_bikes"),
            F.sum("num_docks_available").alias("total_docks"),
            F.count_if(F.col("num_bikes_available") == 0).alias("empty_stations"),
        )
        fresh = stage(fresh, "partials")
        # a few months at most
        months = [r[0] for r in fresh.select(F.coalesce(F.date_format("hour_ts", "yyyyMM"), F.lit("none"))).distinct().collect()]
        there = self.partials.read(months)
        both = fresh if there is None else fresh.unionByName(there)
        merged = both.groupBy(*KEYS).agg(F.expr("bitmap_or_agg(stations)").alias("stations"), *[F.sum(c).alias(c) for c in SUMS])
        return self.partials.merge(merged, KEYS, [F.asc("block")], load_id=load_id, cluster_by=["hour_ts"])

    def _numbered(self, status: DataFrame) -> DataFrame:
        """Readings with the number of their station; readings without a station have none and no bit."""
        known = self.numbers.read()
        new = status.select("station_id").dropna().distinct()
        last = 0
        if known is not None:
            new = new.join(known, "station_id", "left_anti")
            last = known.agg(F.max("number")).first()[0] or 0
        # only stations never seen before are numbered here: a network has some thousands
        place = F.row_number().over(Window.orderBy("station_id")).cast("bigint") + F.lit(last)
        given = new.select("station_id", place.alias("number"), F.lit(None).cast("timestamp").alias("since"))
        self.numbers.merge(stage(given, "station_numbers"), ["station_id"], [F.asc("number")])
        return status.join(self.numbers.read().select("station_id", "number"), "station_id", "left")

    def snapshots(self) -> DataFrame:
        """Network totals of every snapshot, as :func:`~kerbside.plans.hourly.snapshot_totals` gives them."""
        return self.partials.read().groupBy("ingest_ts", "hour_ts").agg(
            F.sum(F.coalesce(F.expr("bitmap_count(stations)"), F.lit(0))).alias("stations_reporting"),
            *[F.sum(c).alias(c) for c in SUMS],
        )
