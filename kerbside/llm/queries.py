"""The queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    decontaminate,
    divergence,
    embedding_dedup,
    hard_negatives,
    html_extract,
    license_scan,
    lm_score,
    mixing,
    packing,
    quality,
    simhash_dedup,
    toxicity,
    url_filter,
)
from kerbside.llm.common import id_remainder, read_table


URL_RULES = (
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = quality.score_quality(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held_out, threshold=0.3
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read_table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(read_table(spark, sf_dir, "pages"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash_dedup.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = toxicity.score_toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held_out, threshold=0.3
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"), min_docs=30, smoothing=5, top=50)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path, capacity=4096, end_id=1)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_dedup": op1_embedding_dedup,
        "op2_url_filter": op2_url_filter,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_decontamination": op4_decontamination,
        "op5_mixing": op5_mixing,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_html_extraction": op7_html_extraction,
        "op8_simhash_dedup": op8_simhash_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_toxicity": op10_toxicity,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_source_divergence": op12_source_divergence,
        "op13_packing": op13_packing,
        "pipeline": pipeline,
    }
