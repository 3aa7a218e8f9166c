"""Running aggregates over a whole table, without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_max(df: DataFrame, order: str, value: str, name: str, bucket: str = "MONTH") -> DataFrame:
    """Adds the largest ``value`` up to each row, by the time column ``order``; rows without one come first.

    A prefix scan: every bucket of time keeps its own running maximum, the maxima of the buckets, one short
    row each, are scanned on their own, and what came before a bucket is joined back to it.
    """
    bucketed = df.withColumn("_bucket", F.date_trunc(bucket, order))
    tops = bucketed.groupBy("_bucket").agg(F.max(value).alias("_top"))
    # one row of buckets, bounded by the calendar, in order; a missing time sorts before all others
    rows = tops.agg(F.array_sort(F.collect_list(F.struct(F.col("_bucket").isNotNull().alias("dated"), "_bucket", "_top"))).alias("_all"))
    before = F.transform(
        "_all",
        lambda b, i: F.struct(b["_bucket"].alias("_b"), F.array_max(F.transform(F.slice("_all", F.lit(1), i), lambda x: x["_top"])).alias("_earlier")),
    )
    scanned = rows.select(F.explode(before).alias("_s")).select("_s.*")
    within = Window.partitionBy("_bucket").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = bucketed.withColumn(name, F.max(value).over(within)).join(scanned, F.col("_bucket").eqNullSafe(F.col("_b")))
    return so_far.withColumn(name, F.greatest(name, "_earlier")).drop("_bucket", "_b", "_earlier")
