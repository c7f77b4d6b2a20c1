"""The pN_ queries: each applies an operator with production settings to whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import defects, leakage, neighbours, personal, quota_sample, rank_fusion, tokens, top_n, varied_subset
from framewright.storage import read_table

DIMS = 64
TOKENIZERS = os.environ.get("FRAMEWRIGHT_TOKENIZERS", "/opt/tokenizers")
SCORES = ["sharpness", "face_sharpness", "exposure_score", "total_score"]


def p1_fused_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = rank_fusion.picture_scores(read_table(spark, sf_dir, "image_metrics"), SCORES)
    return rank_fusion.fuse_rankings(pictures, "image_id", SCORES)


def _quota(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quota_sample.quota_plan(read_table(spark, sf_dir, "image_metrics"), read_table(spark, sf_dir, "sample_targets"), one_in=20)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quota(spark, sf_dir)[1].where("shortfall > 0").select("target_id")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quota(spark, sf_dir)[1]


def p2_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota_sample.draw_sample(*_quota(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, _ = varied_subset.lookalike_groups(read_table(spark, sf_dir, "image_metrics"), "image_id", "feature_vector", DIMS, 0.05)
    return varied_subset.large_groups(people, 10).withColumnRenamed("id", "image_id")


def p3_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return varied_subset.varied_subset(read_table(spark, sf_dir, "image_metrics"), "image_id", "feature_vector", "composition", "head_pose", 200, DIMS)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbours.most_similar(read_table(spark, sf_dir, "image_metrics"), "image_id", "feature_vector", DIMS, 10, probes=12, least=0.98, margin=1.5)
    return near.select(F.least("id", "other_id").alias("image_id_a"), F.greatest("id", "other_id").alias("image_id_b")).distinct()


def p4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches for every picture whose id is divisible by 20, against all pictures."""
    near = neighbours.most_similar(read_table(spark, sf_dir, "image_metrics"), "image_id", "feature_vector", DIMS, 10, query=F.col("id") % 20 == 0)
    return near.select(F.col("id").alias("image_id"), F.col("other_id").alias("neighbour_id"), "similarity", "rank")


def _top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = top_n.latest_scores(read_table(spark, sf_dir, "image_metrics"))
    return top_n.top_n_per_group(pictures, ["trigger_word", "year"], "total_score", "image_id", 3)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top3(spark, sf_dir).select("image_id")


def p5_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top3(spark, sf_dir)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.broken_pairs(read_table(spark, sf_dir, "caption_attempts"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_texts(read_table(spark, sf_dir, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leak_report(p8_found(spark, sf_dir), read_table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "known_names"))


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.redact_personal(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "known_names"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}
