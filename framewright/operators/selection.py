"""Third pass: near-duplicate removal and quota-constrained farthest-first selection.

Both run over a pool of at most ``MAX_POOL`` records (the second pass's top n), in
score order, each choice depending on the ones before it. The pool is checked to be that
small and is then folded in one Arrow group; everything larger has been reduced before.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import vectors
from framewright.operators.quantiles import exact_quantiles

MAX_POOL = 5000
DUPLICATE = 0.05
POSE_BOOST = 1.05


class PoolTooLarge(ValueError):
    """The pool of a sequential selection was not reduced before."""


def checked_pool(pool: DataFrame) -> DataFrame:
    if pool.limit(MAX_POOL + 1).count() > MAX_POOL:
        raise PoolTooLarge(f"more than {MAX_POOL} records; take the best of them first")
    return pool


def distances(features: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
    """Cosine distances in double precision, 1 for zero vectors, 0 to itself, to nine digits."""
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    a = unit(np.asarray(features, float))
    d = np.clip(1 - a @ (a if others is None else unit(np.asarray(others, float))).T, 0, 2)
    if others is None:
        np.fill_diagonal(d, 0)
    return np.round(d, 9)


def composition_quota(target: int) -> dict[str, int]:
    """Seats per composition: 35 % and 45 %, halves to even, the rest full-body."""
    close, medium = round(target * 0.35), round(target * 0.45)
    return {"close-up": close, "medium": medium, "full-body": target - close - medium}


def year_quota(years: list[int], target: int) -> dict[int, int]:
    """Even seats per year, the remainder to the earliest; none for a single year."""
    years = sorted(set(years))
    if len(years) < 2:
        return {}
    base, more = divmod(target, len(years))
    return {y: base + (i < more) for i, y in enumerate(years)}


def kept_after_dedup(d: np.ndarray, threshold: float) -> list[int]:
    """Places in order, each unless one kept before is closer than the threshold."""
    kept: list[int] = []
    for i in range(len(d)):
        if not kept or d[i, kept].min() >= threshold:
            kept.append(i)
    return kept


def farthest_first_places(d: np.ndarray, seats: int) -> list[int]:
    chosen = [0] if len(d) else []
    while len(chosen) < min(seats, len(d)):
        near = d[:, chosen].min(axis=1)
        near[chosen] = -1
        chosen.append(int(near.argmax()))
    return chosen


def quota_farthest_first_places(d: np.ndarray, comps: list, years: list, poses: list, seats: int, temporal_balance: bool = True) -> list[int]:
    """Farthest-first with quotas: places in order of choice.

    Each turn takes from the first tier that has candidates: within composition and year
    quota, within composition quota, within year quota, any. A null year is within the year
    quota, a null composition never within one. A pose not seen yet multiplies the distance by 1.05.
    """
    want = composition_quota(seats)
    per_year = year_quota([y for y in years if y is not None], seats) if temporal_balance else {}
    have: Counter = Counter()
    chosen, near = [], np.full(len(d), np.inf)

    def take(i: int) -> None:
        chosen.append(i)
        np.minimum(near, d[i], out=near)
        have.update({("c", comps[i]): 1, ("y", years[i]): 1, ("p", poses[i]): 1})

    if len(d):
        take(0)
    while len(chosen) < min(seats, len(d)):
        best: tuple[int, float, int] | None = None
        done = set(chosen)
        for i in range(len(d)):
            if i in done:
                continue
            in_comp = comps[i] is not None and have["c", comps[i]] < want.get(comps[i], 0)
            in_year = years[i] is None or not per_year or have["y", years[i]] < per_year.get(years[i], 0)
            tier = 0 if in_comp and in_year else 1 if in_comp else 2 if in_year else 3
            far = near[i] * (POSE_BOOST if poses[i] and not have["p", poses[i]] else 1.0)
            if best is None or (tier, -far) < best[:2]:
                best = (tier, -far, i)
        take(best[2])
    return chosen


def _in_one_group(pool: DataFrame, order: str, columns: list[str], work, schema: str) -> DataFrame:
    """Applies ``work(pandas rows in order)`` to the checked pool."""
    rows = checked_pool(pool).select(F.lit(0).alias("__one"), order, *columns)
    return rows.groupBy("__one").applyInPandas(lambda pdf: work(pdf.sort_values(order, kind="stable").reset_index(drop=True)), schema)


def _features(pdf: pd.DataFrame, vector: str) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in pdf[vector]]) if len(pdf) else np.zeros((0, 1))


def _none(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


def greedy_dedup(pool: DataFrame, key: str, order: str, vector: str, threshold: float = DUPLICATE) -> DataFrame:
    """``key`` of the records kept: in ``order``, unless a kept one is closer than ``threshold``.

    A record close only to a dropped one stays. An empty pool gives no rows.
    """
    kind = pool.schema[key].dataType.simpleString()
    return _in_one_group(pool, order, [key, vector] if key != order else [vector], lambda p: p.iloc[kept_after_dedup(distances(_features(p, vector)), threshold)][[key]] if len(p) else p[[key]], f"{key} {kind}")


def farthest_first(pool: DataFrame, key: str, order: str, vector: str, seats: int) -> DataFrame:
    """``key`` and ``turn`` (from 1) of ``seats`` records far from each other, the first in ``order`` first."""
    kind = pool.schema[key].dataType.simpleString()

    def work(p: pd.DataFrame) -> pd.DataFrame:
        at = farthest_first_places(distances(_features(p, vector)), seats)
        return p.iloc[at][[key]].assign(turn=range(1, len(at) + 1))

    return _in_one_group(pool, order, [key, vector] if key != order else [vector], work, f"{key} {kind}, turn int")


def diverse_selection(pool: DataFrame, seats: int = 30, key: str = "path", order: str = "place", vector: str = "feature_vector", temporal_balance: bool = True, threshold: float = DUPLICATE) -> DataFrame:
    """The third pass: ``key`` and ``turn`` of the selected records.

    Records without a vector are left out. If no more than ``seats`` remain, before or
    after near-duplicates are dropped, all of them are selected in order.
    """
    kind = pool.schema[key].dataType.simpleString()

    def work(p: pd.DataFrame) -> pd.DataFrame:
        if len(p) > seats:
            p = p.iloc[kept_after_dedup(distances(_features(p, vector)), threshold)].reset_index(drop=True)
        at = list(range(len(p)))
        if len(p) > seats:
            at = quota_farthest_first_places(distances(_features(p, vector)), _none(p["composition"]), _none(p["year"]), _none(p["head_pose"]), seats, temporal_balance)
        return p.iloc[at][[key]].assign(turn=range(1, len(at) + 1))

    readable = pool.where(F.col(vector).isNotNull())
    return _in_one_group(readable, order, [key, vector, "composition", "year", "head_pose"], work, f"{key} {kind}, turn int")


def cosine_pairs(pool: DataFrame, key: str, vector: str) -> DataFrame:
    """All pairs of a checked pool with their distance to nine digits, smaller key first."""
    a = checked_pool(pool).select(F.col(key).alias("a"), F.col(vector).alias("va"))
    b = pool.select(F.col(key).alias("b"), F.col(vector).alias("vb"))
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", F.round(vectors.cosine_distance(F.col("va"), F.col("vb")), 9).alias("distance"))


def near_duplicates(pool: DataFrame, key: str, vector: str, threshold: float = DUPLICATE) -> DataFrame:
    return cosine_pairs(pool, key, vector).where(F.col("distance") < threshold)


def median_vector(records: DataFrame, vector: str) -> DataFrame:
    """``pos``, ``value``: the exact median of each dimension, of any number of rows (see ``exact_quantiles``)."""
    found = exact_quantiles(records.select(F.posexplode(vector).alias("series", "value")), 0.5)
    return records.sparkSession.createDataFrame(sorted(found.items()), "pos int, value double")


def distance_to_median(records: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and ``distance`` of each record to the median vector, which is one broadcast row."""
    middle = median_vector(records, vector).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("__m"))
    rows = records.select(key, F.col(vector).alias("__v")).crossJoin(F.broadcast(middle))
    return rows.select(key, F.round(vectors.cosine_distance(F.col("__v"), F.col("__m")), 9).alias("distance"))


def consensus_outliers(records: DataFrame, key: str, vector: str) -> DataFrame:
    """The farthest 5 % from the median vector, at least one; ties go to the larger key."""
    far = distance_to_median(checked_pool(records), key, vector)
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("distance").desc(), F.col(key).desc()))
    return far.withColumn("__n", n).withColumn("__r", rank).where(F.col("__r") <= F.greatest(F.lit(1), (F.col("__n") * 0.05).cast("int"))).select(key, "distance")
