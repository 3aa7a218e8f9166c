"""Batch outputs: partitioned appends, dead letters, incremental merge, materialisation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside import fixed_values as fx
from kerbside.operators.latest import latest_by
from kerbside.session import shuffles_released
from kerbside.sources.published import PublishedTable


#: Bytes of text, before compression, that one task sorts and writes of a table of long rows.
PIECE_BYTES = 64 << 20


def in_pieces(df: DataFrame, *order: str, piece_bytes: int | None = None) -> DataFrame:
    """Rows dealt over tasks by what they weigh uncompressed, in ranges of ``order``.

    AQE cuts by the bytes of compressed shuffle files; long texts that compress a hundredfold would meet in
    one task. ``df`` is read twice here and once later, so pass it staged or persisted.
    """
    # a row is at least as heavy as its fixed part
    weight = F.lit(8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            weight = weight + F.coalesce(F.octet_length(f.name), F.lit(0))
    total = df.agg(F.sum(weight)).first()[0] or 0
    pieces = 1 + int(total) // (piece_bytes or PIECE_BYTES)
    # equal rows are spread too
    spread = F.xxhash64(F.monotonically_increasing_id())
    return df.withColumn("_spread", spread).repartitionByRange(pieces, *order, "_spread").drop("_spread")


def append_by_day(df: DataFrame, path: str, ts: str = "ingest_ts", cluster_by: str | None = "station_id",
                  mode: str = "append") -> None:
    """Append to a Parquet table partitioned by day and sorted inside each file.

    Rows are rebalanced by day rather than repartitioned by it: a small day becomes one
    file, while a day holding most rows is split over many tasks by AQE.
    """
    day = F.to_date(ts)
    out = df.withColumn("ingest_date", day).hint("rebalance", "ingest_date")
    order = ["ingest_date"] + ([cluster_by] if cluster_by else [])
    out.sortWithinPartitions(*order).write.mode(mode).partitionBy("ingest_date").parquet(path)


def write_dead_letters(branches: list[DataFrame], path: str | None) -> None:
    """All dead-letter branches into one day-partitioned table; nothing when no target is set.

    Branches are read three times, so pass them from a staged or persisted table.
    """
    if path is None or not branches:
        return
    merged = branches[0]
    for branch in branches[1:]:
        merged = merged.unionByName(branch)
    days = in_pieces(merged.withColumn("ingest_date", F.to_date("dlq_ts")), "ingest_date")
    days.sortWithinPartitions("ingest_date", "stage").write.mode("append").partitionBy("ingest_date").parquet(path)


def push_dead_letters(
    failed: DataFrame, subscription: str, max_attempts: int = fx.MAX_DELIVERY_ATTEMPTS
) -> DataFrame:
    """Messages whose delivery failed ``max_attempts`` times, with their metadata.

    ``failed``: message_id, publish_time, data (base64 text), attributes (map), attempt.
    """
    return failed.filter(F.col("attempt") >= max_attempts).select(
        F.lit(subscription).alias("subscription_name"),
        "message_id",
        "publish_time",
        F.expr("try_to_binary(data, 'base64')").alias("data"),
        "attributes",
    )


def write_ndjson(df: DataFrame, path: str, shards: int | None = None) -> None:
    """Newline-delimited JSON, NULL members written out, optionally in a fixed number of files."""
    out = df.repartition(shards) if shards else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, path: str, ts: str = "ingest_ts", load_id: str | None = None) -> DataFrame:
    """Materialise ``df`` as a table that readers see before or after this load, never in between."""
    table = PublishedTable(df.sparkSession, path, ts)
    table.replace(df, load_id)
    return table.read()


def merge_incremental(
    new: DataFrame,
    path: str,
    keys: list[str],
    order: list[Column],
    ts: str = "ingest_ts",
    lookback: str | None = "1 minute",
    evolve_schema: bool = False,
    cluster_by: list[str] | None = None,
) -> None:
    """Load rows newer than the target's newest ``ts`` minus ``lookback``; equal keys are replaced.

    ``keys`` must contain ``ts`` or something that fixes its month: rows of other months are not looked at.
    :class:`PublishedTable` merges by any key, and shows its readers no month between old and new.

    Without a ``lookback`` all rows are loaded, however old, as a stream needs it whose files do not
    come in the order of ``ts``. The target is Parquet partitioned by month, and this function's own: a
    key occurs once in it. Only months from the
    high-water mark on, or those the new rows belong to, are read back and rewritten, through dynamic
    partition overwrite, so the cost follows the new data and not the history; a reader may see
    a month between its old and new files. Where ``ts`` is a key, rows up to the mark can't be replaced
    and go from their files to the new ones without a shuffle. Shuffle files are removed when the load is
    written. Running it twice on the same input changes nothing. With
    ``evolve_schema`` columns that only one side has are kept, as NULL on the other side. Files are
    sorted by ``cluster_by`` (the first key without it).
    """
    incoming = new.withColumn("ingest_month", F.date_format(ts, "yyyyMM")).withColumn("_is_new", F.lit(True))
    target = _existing_table(new.sparkSession, path, evolve_schema)
    kept = settled = None
    if target is not None and lookback is None:
        # the months of this load: a few texts
        months = [r[0] for r in incoming.select("ingest_month").distinct().collect()]
        dated = [int(m) for m in months if m is not None]
        same = F.col("ingest_month").isin(dated) if dated else F.lit(False)
        # rows without a time have a folder of their own, which is rewritten like a month
        kept = target.filter(same | F.col("ingest_month").isNull() if None in months else same)
    elif target is not None:
        newest = _newest_month(target)
        if newest is not None:
            # the newest rows lie in the newest month; no other partition is read for the mark
            mark = F.max(ts) - F.expr(f"interval {lookback}")
            row = target.filter(F.col("ingest_month") == newest).agg(mark.alias("mark")).first()
            loaded = (F.col(ts) > F.lit(row["mark"])) | F.col(ts).isNull()
            incoming = incoming.filter(loaded)
            # a literal month, so that older partitions are pruned without being listed
            kept = target.filter(
                (F.col("ingest_month") >= int(row["mark"].strftime("%Y%m"))) | F.col("ingest_month").isNull()
            )
            if ts in keys:
                # an incoming row's key has a time that is loaded
                kept, settled = kept.filter(loaded), kept.filter(~loaded)
    merged = _merged(incoming, kept, keys, order, evolve_schema).drop("_is_new").hint("rebalance", "ingest_month")
    if settled is not None:
        merged = merged.unionByName(_month_as_text(settled), allowMissingColumns=evolve_schema)
    with shuffles_released(new.sparkSession):
        (
            merged.sortWithinPartitions("ingest_month", *(cluster_by or keys[:1]))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingest_month")
            .parquet(path)
        )


def _merged(
    incoming: DataFrame, kept: DataFrame | None, keys: list[str], order: list[Column], evolve_schema: bool
) -> DataFrame:
    """One row a key, an incoming one where there is one."""
    ranking = [F.desc("_is_new"), *order]
    if kept is None:
        return latest_by(incoming, keys, ranking)
    kept = _month_as_text(kept).withColumn("_is_new", F.lit(False))
    if not evolve_schema:
        # each side is dealt by key for itself, and their union stays dealt so: an incoming row moves once
        incoming, kept = latest_by(incoming, keys, order), latest_by(kept, keys, order)
    return latest_by(incoming.unionByName(kept, allowMissingColumns=evolve_schema), keys, ranking)


def _month_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ingest_month", F.col("ingest_month").cast("string"))


def _newest_month(target: DataFrame) -> int | None:
    """Newest month that has rows, from the folder names; rows without a time have no month."""
    months = target.filter("ingest_month is not null").select(F.max("ingest_month").alias("m")).first()
    return months["m"]


def _existing_table(spark: SparkSession, path: str, merge_schema: bool) -> DataFrame | None:
    """The target, None if there is none yet. A target that can't be read is an error, not an absence."""
    try:
        return spark.read.option("mergeSchema", merge_schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
