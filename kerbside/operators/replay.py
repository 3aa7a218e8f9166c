"""Dead-letter replay: plan, publish, remember."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import fixed_values as fx
from kerbside.sources.readers import path_exists

_LOG = logging.getLogger(__name__)

PLAN_COLUMNS = ("message_id", "publish_time", "data", "attributes", "action", "acknowledge")


def plan_replay(
    dlq: DataFrame,
    run_id: str,
    source: str,
    max_messages: int | None = fx.MAX_REPLAY_MESSAGES,
    dry_run: bool = False,
    enabled: bool = True,
    ack_skipped: bool = False,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """What one replay run does with the oldest ``max_messages`` dead letters, or with all of them (None).

    ``action`` is ``republished`` or ``skipped`` (the loop guard: already replayed once).
    ``acknowledge`` marks messages that must not come back; the ledger of earlier runs keeps
    them out. Skipped messages count towards ``max_messages``. Attributes of republished rows
    are cleaned of delivery metadata and drill flags and stamped with this run.
    """
    waiting = dlq if enabled else dlq.filter(F.lit(False))
    if ledger is not None:
        waiting = waiting.join(ledger.select("message_id").distinct(), "message_id", "left_anti")
    pulled = waiting
    if max_messages is not None:
        pulled = waiting.orderBy(F.asc("publish_time"), F.asc("message_id")).limit(max_messages)
    replayed = F.coalesce(F.lower(F.col("attributes")[fx.REPLAY_ATTRIBUTE]) == "true", F.lit(False))
    stamps = {
        fx.REPLAY_ATTRIBUTE: "true",
        fx.REPLAY_ID_ATTRIBUTE: run_id,
        fx.REPLAY_SOURCE_ATTRIBUTE: source.rsplit("/", 1)[-1],
    }
    clean = F.map_filter(
        F.coalesce("attributes", F.create_map().cast("map<string,string>")),
        lambda k, v: ~k.startswith(fx.DEAD_LETTER_ATTRIBUTE_PREFIX) & ~k.isin(fx.DRILL_ATTRIBUTE, *stamps),
    )
    stamped = F.map_concat(clean, F.create_map(*[F.lit(x) for pair in stamps.items() for x in pair]))
    skipped = F.col("action") == "skipped"
    return (
        pulled.withColumn("action", F.when(replayed, "skipped").otherwise("republished"))
        .withColumn("attributes", F.when(skipped, F.col("attributes")).otherwise(stamped))
        .withColumn("acknowledge", F.lit(not dry_run) & (~skipped | F.lit(ack_skipped)))
        .select(*PLAN_COLUMNS)
    )


def summarise_replay(plan: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """One row: pulled, republished, acked, skipped, failed.

    With ``written``, the batch a run has stored, planned messages that are not in it count as failed
    and are not acknowledged.
    """
    if written is not None:
        stored = written.select("message_id", F.lit(True).alias("_stored")).distinct()
        missing = (F.col("action") == "republished") & F.col("_stored").isNull()
        plan = (
            plan.join(stored, "message_id", "left")
            .withColumn("acknowledge", F.col("acknowledge") & ~missing)
            .withColumn("action", F.when(missing, "failed").otherwise(F.col("action")))
        )
    action = F.col("action")
    return plan.agg(
        F.count(F.lit(1)).alias("pulled"),
        F.count_if(action == "republished").alias("republished"),
        F.count_if("acknowledge").alias("acked"),
        F.count_if(action == "skipped").alias("skipped"),
        F.count_if(action == "failed").alias("failed"),
    )


def run_replay(plan: DataFrame, batch_path: str, ledger_path: str, run_id: str, dry_run: bool = False) -> int:
    """Write the messages to replay under the run's id, then remember them; 0 on success, 2 on failure.

    A run is planned once: where its batch is stored, a repeat only fills the ledger from it, whatever the
    new plan says, and where the ledger is there too, it does nothing. So a run that dies between the two
    can be repeated without losing or doubling a message. The error of a failed run goes to the log.
    """
    if dry_run:
        return 0
    spark = plan.sparkSession
    batch, stored = f"{batch_path}/run_id={run_id}", f"{ledger_path}/run_id={run_id}"
    try:
        if path_exists(spark, f"{stored}/_SUCCESS"):
            return 0
        if not path_exists(spark, f"{batch}/_SUCCESS"):
            plan.write.mode("overwrite").partitionBy("action", "acknowledge").parquet(batch)
        done = spark.read.schema(plan.schema).parquet(batch)
        done.filter("acknowledge").select("message_id").write.mode("overwrite").parquet(stored)
    except Exception:  # a failed run reports and leaves its messages for the next one
        _LOG.exception("replay run %s failed", run_id)
        return 2
    return 0


def replayed_messages(spark: SparkSession, batch_path: str) -> DataFrame:
    """Messages that the runs under ``batch_path`` have republished."""
    return spark.read.parquet(batch_path).filter("action = 'republished'").drop("action", "acknowledge")
