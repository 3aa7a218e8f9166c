"""Message ids that have been seen, for redeliveries that come later than any watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.latest import latest_by
from kerbside.session import stage
from kerbside.sources.readers import path_exists

_INDEX = "message_id string, first_seen timestamp, bucket int, load string"


class SeenIds:
    """An index of ids at ``path``, partitioned by a hash of the id and by load.

    A batch is compared with the index alone, never with the messages themselves: two columns, the
    buckets the batch falls into, and in each file only the pages whose id range or Bloom filter lets
    one of the ids be there. A repeated load replaces its own entries and is not compared with them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def ids(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(self.path)

    def fresh(self, messages: DataFrame, load_id: str, ts: str = "publish_time") -> DataFrame:
        """The messages of a batch whose id is new, the earliest of each id; the ids are remembered.

        Messages without an id cannot be told apart and pass. Among equal times the rest of the row decides.
        """
        bucket = F.pmod(F.xxhash64("message_id"), F.lit(self.buckets)).cast("int")
        keyed = stage(messages.withColumn("_bucket", bucket), "messages")
        simple = [f.name for f in messages.schema if f.dataType.typeName() not in ("map", "variant", "array", "struct")]
        order = [F.asc_nulls_last(ts), *[F.asc(c) for c in simple if c not in ("message_id", ts)]]
        first = latest_by(keyed.filter("message_id is not null"), ["message_id"], order)
        # at most ``buckets`` numbers
        there = [r[0] for r in keyed.select("_bucket").distinct().collect()]
        index = self.ids().filter(F.col("bucket").isin(there) & (F.col("load") != F.lit(load_id)))
        wanted = keyed.select("message_id", F.col("_bucket").alias("bucket")).distinct()
        # the few that are known, then the batch without them: the index is only read, never kept or sorted whole
        known = index.join(wanted, ["bucket", "message_id"], "left_semi").select("message_id").distinct()
        new = stage(first.join(known, "message_id", "left_anti"), "fresh_messages")
        entry = new.select("message_id", F.col(ts).cast("timestamp").alias("first_seen"), F.col("_bucket").alias("bucket"))
        (
            entry.withColumn("load", F.lit(load_id)).repartition("bucket").sortWithinPartitions("bucket", "message_id")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("parquet.bloom.filter.enabled#message_id", "true")
            .partitionBy("bucket", "load").parquet(self.path)
        )
        nameless = keyed.filter("message_id is null")
        return new.select(messages.columns).unionByName(nameless.select(messages.columns))
