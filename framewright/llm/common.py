"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(score: Column | str) -> Column:
    """Score as double with NaN turned into null and -0.0 into 0.0."""
    c = (F.col(score) if isinstance(score, str) else score).cast("double")
    return F.when(~F.isnan(c), c + F.lit(0.0))


def latest_rows(df: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """One row per non-null ``key``: the one with the largest ``order`` columns.

    Ties on ``order`` go to the largest ``values`` (null last), so repeated
    rows and ties give the same result on every run. Only the named columns
    are kept. The rank filter is also applied before the shuffle, so a key
    with very many rows sends one row per map task.
    """
    cols = list(dict.fromkeys([key, *order, *values]))
    rank = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *values]])
    rows = df.select(*cols).where(F.col(key).isNotNull())
    return rows.withColumn("__rank", F.row_number().over(rank)).where("__rank = 1").select(key, *values)


#: A key with more than one in so many rows is joined by broadcast; there are fewer such keys than this.
HOT_ONE_IN = 1000


def hot_bound(total: int) -> int:
    """A key with more rows than this is hot; fewer than ``HOT_ONE_IN`` keys are."""
    return max(10_000, total // HOT_ONE_IN)


def skew_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, bound: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``facts``, one row of which has a key, in which no key is a hot one.

    ``facts`` has in ``weight`` how many of ``rows`` share the key (an upper bound will do).
    The facts of keys above ``hot_bound`` are broadcast, so their rows stay where they
    are; all other rows are shuffled as usual. Both sides should be cheap to read
    again. ``bound`` saves the look at the weights. ``weight`` is dropped.
    """
    if bound is None:
        total, most = facts.agg(F.sum(weight), F.max(weight)).first()
        bound = hot_bound(total or 0)
        if (most or 0) <= bound:
            return rows.join(facts.drop(weight), keys)
    hot = F.broadcast(facts.where(F.col(weight) > bound).drop(weight))
    cold = facts.where(F.col(weight) <= bound).drop(weight)
    return rows.join(hot, keys).unionByName(rows.join(F.broadcast(facts.where(F.col(weight) > bound).select(*keys)), keys, "left_anti").join(cold, keys))


def null_safe_equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Join condition on ``columns`` that treats two nulls as equal."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])
