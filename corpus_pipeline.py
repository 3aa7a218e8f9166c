"""The corpus pipeline: stages that call the operators in kerbside/llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; what it returns is written
as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import decontaminate, mixing, quality, simhash_dedup, toxicity
from kerbside.llm.common import prepare, read_table
from kerbside.session import stage


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group: 3-word shingles, 2 bits."""
    prepare(spark)
    return simhash_dedup.drop_near_copies(docs, shingle=3, max_bits=2)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.sample_mixture(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_filter),
    ("mixing sources", mixture),
]

#: The stages that learn (toxicity, quality) can't be expressed in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_").lower())
    return docs
