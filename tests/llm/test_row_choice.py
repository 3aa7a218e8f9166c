"""Decisions about rows come to the texts; no text is shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from kerbside.llm import decontaminate, simhash_dedup
from kerbside.llm.common import PART, ROW, choose_rows, prepare, with_row_key


def shuffled_scans(df):
    """Scans of a text column that lie below an exchange."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        above = [(d, x) for d, x in above if d < depth] + [(depth, line)]
        if "FileScan" in line and "text#" in line.split("Batched")[0]:
            if any("Exchange" in x for _, x in above):
                found.append(line)
    return found


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_are_chosen_one_by_one(no_broadcast):
    spark = no_broadcast
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).repartition(3)
    rows = with_row_key(docs)
    numbered = {r.doc_id: r[ROW] for r in rows.collect()}
    assert len(set(numbered.values())) == 100_000 and set(rows.columns) == {"doc_id", "text", ROW, PART}
    wanted = set(random.Random(1).sample(range(100_000), 30_000)) | {min(numbered, key=numbered.get), max(numbered, key=numbered.get)}
    chosen = spark.createDataFrame([(numbered[i],) for i in wanted], f"{ROW} bigint")
    kept, others = choose_rows(rows, chosen), choose_rows(rows, chosen, keep=False)
    assert {r.doc_id for r in kept.collect()} == wanted
    assert {r.doc_id for r in others.collect()} == set(range(100_000)) - wanted
    assert choose_rows(rows, chosen.limit(0)).count() == 0 and choose_rows(rows, chosen.limit(0), keep=False).count() == 100_000
    empty = with_row_key(docs.limit(0))
    assert choose_rows(empty, chosen).count() == 0


def test_stages_shuffle_no_text(no_broadcast):
    spark = prepare(no_broadcast)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")  # more than the documents have
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for kept in (simhash_dedup.drop_near_copies(docs), decontaminate.drop_contaminated(docs, items)):
        assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
        assert "text#" in kept._jdf.queryExecution().executedPlan().toString() and not shuffled_scans(kept)
