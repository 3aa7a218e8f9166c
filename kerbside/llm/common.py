"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import configure, stage, staging_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of whole texts in one Arrow batch; keeps a Python worker's memory to a few MB of text.
BATCH_ROWS = "1000"
#: Column that names a row where ids may be NULL or repeated.
ROW = "_kerbside_row"
#: Column with the task that numbered the row, which is the row's number without its last ROW_BITS bits.
PART, ROW_BITS = "_kerbside_part", 33


def prepare(spark: SparkSession) -> SparkSession:
    """Settings these operators rely on: AQE with skew handling, small Arrow batches of texts, and this
    package on the Python workers' path (where it lies at another place there, ship it with --py-files)."""
    configure(spark)
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, in any locale."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def labelled_sample(documents: DataFrame, labels: DataFrame, target: str, learnable: Column, limit: int) -> DataFrame:
    """(doc_id, text, target) of about ``limit`` labelled documents and never more.

    An id is drawn by its hash, so the draw is the same at any partitioning. Ids with contradictory labels
    take the smaller one; of rows that share an id the text with the smallest hash counts. ``learnable`` is an
    expression over doc_id. The drawn ids are ``limit`` rows at most, which is what allows the broadcast.
    """
    usable = (
        labels.select("doc_id", F.col(target).cast("int").alias("target"))
        .where(F.col("target").isin(0, 1) & F.col("doc_id").isNotNull() & learnable)
        .groupBy("doc_id")
        .agg(F.min("target").alias("target"))
    )
    total = labels.count()
    scale = 1 << 30
    share = min(1.0, limit / max(total, 1))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.lit(int(share * scale)))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id", "target").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def with_row_key(documents: DataFrame) -> DataFrame:
    """``documents`` with a number of its own for every row, written once so that the numbers stay.

    The table is bucketed by the task that wrote the row (:data:`PART`), which costs no shuffle, so that
    decisions about rows can come to the texts and the texts never travel.
    """
    spark = documents.sparkSession
    parts = documents.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]
    keyed = documents.withColumn(ROW, F.monotonically_increasing_id())
    keyed = keyed.withColumn(PART, F.shiftright(ROW, ROW_BITS))
    name = f"kerbside_rows_{uuid.uuid4().hex}"
    # with fewer buckets than shuffle partitions Spark would rather shuffle the texts; more than 100,000 it refuses
    buckets = min(max((parts or 0) + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))), 100_000)
    path = f"{staging_dir(spark)}/kerbside/{name}"
    keyed.write.format("parquet").bucketBy(buckets, PART).option("path", path).saveAsTable(name)
    return spark.read.table(name)


def choose_rows(rows: DataFrame, chosen: DataFrame, keep: bool = True) -> DataFrame:
    """The rows of :func:`with_row_key` that are in ``chosen`` (a column :data:`ROW`), or all others.

    The choice becomes bitmaps, an eighth of a byte a row of the tasks it falls into, and those are dealt
    to the buckets of the rows; the hint keeps it so at every size.
    """
    place = F.col(ROW).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    block, bit = F.floor(place / F.lit(32768)), place % 32768
    bitmaps = (
        chosen.select(F.shiftright(ROW, ROW_BITS).alias(PART), block.alias("block"), bit.alias("bit"))
        .groupBy(PART, "block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
        .groupBy(PART).agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("_chosen"))
    )
    byte = F.substring(F.col("_chosen")[block], (F.floor(bit / F.lit(8)) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    # the bit's own value, since a shift by a column is for expressions only
    weight = F.pow(F.lit(2), bit % 8).cast("int")
    is_chosen = F.coalesce(value.bitwiseAND(weight) != 0, F.lit(False))
    joined = rows.join(bitmaps.hint("shuffle_hash"), PART, "left")
    return joined.where(is_chosen if keep else ~is_chosen).drop("_chosen")


def bounded_draw(documents: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, draw) of about ``limit`` different rows and never more, the same at any partitioning.

    Drawn by a hash of id and text, so rows that share an id, NULL included, are drawn one by one; copies of
    a row count once. What comes to the last sort is about ``limit`` rows whatever the input.
    """
    total = documents.count()
    scale = 1 << 30
    share = min(1.0, limit / max(total, 1))
    keyed = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("draw"))
    passed = keyed.where(F.pmod("draw", F.lit(scale)) < F.lit(int(share * scale)))
    return passed.dropDuplicates(["draw"]).orderBy("draw").limit(limit)
