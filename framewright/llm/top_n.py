"""Problem 5: the N best items of every group, by two-stage salted ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import finite, latest_rows


def top_n_per_group(items: DataFrame, groups: list[str], score: str, item_id: str, n: int, subgroups: int = 32) -> DataFrame:
    """The ``n`` items with the highest ``score`` in every group.

    Each group is hashed into ``subgroups`` by item, the best ``n`` of each
    subgroup are kept, and the survivors (at most ``n * subgroups`` a group)
    are ranked by score and identifier. No task sees a whole hot group.

    Null group values form groups of their own. Items whose score or id is null
    or whose score is NaN are left out; equal scores go to the smaller id;
    repeated (group, id, score) rows count once; groups with fewer items give
    all; an empty input gives no rows. Other input columns are ignored.
    Returns the group columns, ``item_id``, ``score`` and ``rank`` from 1.
    """
    keys = [f"__g{i}" for i in range(len(groups))]
    rows = items.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(item_id).alias("__id"), finite(score).alias("__score"))
    rows = rows.where("__id is not null and __score is not null").withColumn("__salt", F.pmod(F.xxhash64("__id"), F.lit(subgroups)))
    best = [F.col("__score").desc(), F.col("__id").asc()]
    first = Window.partitionBy(*keys, "__salt").orderBy(*best)
    # dense_rank: repeated rows of one item share a rank and are removed below
    kept = rows.withColumn("__r", F.dense_rank().over(first)).where(F.col("__r") <= n).drop("__r").dropDuplicates()
    last = Window.partitionBy(*keys).orderBy(*best)
    ranked = kept.withColumn("__rank", F.row_number().over(last)).where(F.col("__rank") <= n)
    return ranked.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.col("__id").alias(item_id), F.col("__score").alias(score), F.col("__rank").alias("rank"))


def latest_scores(metrics: DataFrame) -> DataFrame:
    """A picture's latest scan: trigger word, year and total score."""
    return latest_rows(metrics, "image_id", ["scanned_at", "ingested_at"], ["total_score", "trigger_word", "year"])
