"""As-of join: every reading with the version of its key that was valid at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.latest import latest_by


def validity_intervals(
    versions: DataFrame, keys: Sequence[str], valid_from: str, tie_break: Sequence[Column] = ()
) -> DataFrame:
    """Adds ``valid_to``, the start of the key's next version (NULL: still valid).

    Of versions that start at the same time the first in ``tie_break`` counts; versions without a key or a
    start are never valid.
    """
    usable = versions.dropna(subset=[*keys, valid_from])
    single = latest_by(usable, [*keys, valid_from], list(tie_break) or [F.asc(c) for c in versions.columns])
    following = Window.partitionBy(*keys).orderBy(valid_from)
    return single.withColumn("valid_to", F.lead(valid_from).over(following))


def join_as_of(
    readings: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    valid_from: str,
    columns: Sequence[str],
    bucket: str = "DAY",
) -> DataFrame:
    """``readings`` with ``columns`` of the version valid at ``time``; NULL before a key's first one.

    One sorted pass over readings and versions together, in groups of a key and a ``bucket`` of time, so a
    key that holds most readings is spread over its days. What is valid when a bucket begins comes from a
    pass over the far fewer (key, bucket) pairs. A version counts from its start on, the start included.
    ``versions`` has one row a key and start (:func:`validity_intervals`); its ``columns`` must not be
    among those of the readings. Readings without a key or time have no version.
    """
    keys = list(keys)
    # a time of its own, of one type on both sides, whatever the sides call and type it
    at, start = F.col(time).cast("timestamp_ntz"), F.col(valid_from).cast("timestamp_ntz")
    version = F.struct(*[F.col(c) for c in columns])
    whole = F.lit(True)
    for c in (*keys, time):
        whole = whole & F.col(c).isNotNull()
    reading = F.struct(*[F.col(c) for c in readings.columns])
    dated = readings.filter(whole).select(*keys, at.alias("_at"), reading.alias("_reading"))
    dated = dated.withColumn("_bucket", F.date_trunc(bucket, "_at").cast("timestamp_ntz"))
    started = versions.dropna(subset=[*keys, valid_from]).select(*keys, start.alias("_at"), version.alias("_version"))

    # the version each bucket of each key begins with
    none = F.lit(None).cast(started.schema["_version"].dataType)
    pairs = dated.select(*keys, F.col("_bucket").alias("_at")).distinct().withColumn("_version", none)
    both = pairs.withColumn("_kind", F.lit(0)).unionByName(started.withColumn("_kind", F.lit(1)))
    so_far = Window.partitionBy(*keys).orderBy("_at", F.desc("_kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_kind = 0")
    opening = begun.filter("_version is not null").withColumn("_bucket", F.col("_at")).drop("_kind")

    # versions that start inside a bucket with readings, at their own time
    inside = started.withColumn("_bucket", F.date_trunc(bucket, "_at").cast("timestamp_ntz"))
    blank = F.lit(None).cast(dated.schema["_reading"].dataType)
    steps = opening.unionByName(inside).withColumn("_reading", blank)
    merged = dated.withColumn("_version", none).unionByName(steps)
    order = Window.partitionBy(*keys, "_bucket").orderBy(
        "_at", F.col("_reading").isNotNull(), F.when(F.col("_version").isNotNull(), F.col("_at") == F.col("_bucket"))
    )
    valid = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = merged.withColumn("_valid", valid).filter("_reading is not null")
    out = joined.select("_reading.*", *[F.col("_valid")[c].alias(c) for c in columns])
    lost = readings.filter(~whole).select("*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    return out.unionByName(lost)
