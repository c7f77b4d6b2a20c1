"""Curation as one plan: score, stratify, diversify, refine, and the export of what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions import vectors
from framewright.operators import filters, ranking, refinement, selection
from framewright.storage import materialize


def pool_of(records: DataFrame, top_n: int, temporal_balance: bool = True, favor_no_glasses: bool = True, tie: str = "path") -> DataFrame:
    """The second pass: the best ``top_n`` records by freshly computed score, with ``place``."""
    rows = ranking.scored(records, favor_no_glasses)
    return ranking.stratified_top_n(rows, top_n, temporal_balance, tie)


def curate(records: DataFrame, verdicts: DataFrame, target: int = 30, top_n: int = 100, era: str | None = None, dims: int = 64, temporal_balance: bool = True, favor_no_glasses: bool = True, drop_sunglasses: bool = False, tie: str = "path") -> DataFrame:
    """Records of the refined portfolio with ``seat``.

    Distributed work ends with the second pass: its at most ``max(top_n, 2 * target)``
    records are written to the shared folder, and the sequential passes fold over them.
    """
    rows = filters.era_window(records, era)
    pool = pool_of(rows, ranking.top_n_floor(top_n, target), temporal_balance, favor_no_glasses, tie)
    pool = materialize(pool.withColumn("feature_vector", F.when(vectors.usable(F.col("feature_vector"), dims), F.col("feature_vector"))), "pool")
    turns = selection.diverse_selection(pool, target, temporal_balance=temporal_balance)
    judged = refinement.with_verdicts(pool.join(F.broadcast(turns), "path", "left"), verdicts)
    seats = refinement.refine(judged, favor_no_glasses=favor_no_glasses, drop_sunglasses=drop_sunglasses)
    return pool.join(F.broadcast(seats), "path")
