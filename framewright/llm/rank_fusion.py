"""Problem 1: one ranking from several scores, by reciprocal rank fusion."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import finite, latest_rows
from framewright.storage import materialize

#: Contributions are summed as whole numbers of 1/SCALE: sums are exact, so ties are true ties.
SCALE = 1e18


def _splits(quantiles: list[float] | None) -> tuple[list[float], set[float]]:
    """Bucket bounds for one score and the values that fill a bucket alone."""
    inner, heavy = [], set()
    for v in quantiles or []:
        if math.isinf(v):
            continue
        if inner and inner[-1] == v:
            heavy.add(v)
        else:
            inner.append(v)
    bounds = set(inner) | {math.nextafter(v, math.inf) for v in heavy}
    # one bound that no value reaches keeps the list long enough when there are no values
    return [-math.inf, *sorted(bounds or {0.0}), math.inf], heavy


def add_ranks(items: DataFrame, item_id: str, scores: list[str], rows_per_bucket: int = 50_000, max_buckets: int = 4096) -> DataFrame:
    """Rank of every item by each score, 1 for the highest, equal scores sharing the smallest rank.

    A global window would put all rows into one task. Here value buckets are
    cut at approximate quantiles, exact bucket counts give each bucket's
    offset, and only the place inside a bucket needs a window. A value that
    repeats across quantiles gets a bucket of its own, whose rank is the offset
    itself, so a value held by a third of all rows needs no window and no shuffle.
    The driver sees only the bounds and counts, at most ``2 * max_buckets`` a score.

    ``items`` must be cheap to read again (a table); one row per item. Null and
    NaN scores get no row. Returns ``item_id``, ``series`` (index of the score)
    and ``rank``.
    """
    spark = items.sparkSession
    clean = items.select(F.col(item_id).alias("__id"), *[finite(s).alias(f"__s{i}") for i, s in enumerate(scores)])
    n = clean.count()
    buckets = max(16, min(max_buckets, -(-n // rows_per_bucket)))
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    row = clean.agg(*[F.percentile_approx(f"__s{i}", cuts, F.lit(8 * buckets)).alias(f"q{i}") for i in range(len(scores))]).first()
    bounds = [_splits(row[i]) for i in range(len(scores))]
    cut = Bucketizer(
        splitsArray=[b for b, _ in bounds], inputCols=[f"__s{i}" for i in range(len(scores))],
        outputCols=[f"__b{i}" for i in range(len(scores))], handleInvalid="keep",
    ).transform(clean)
    each = F.array(*[F.struct(F.lit(i).alias("series"), F.col(f"__s{i}").alias("value"), F.col(f"__b{i}").cast("int").alias("bucket")) for i in range(len(scores))])
    long = cut.select("__id", F.explode(each).alias("x")).select("__id", "x.*").where("value is not null")
    counts = {(r["series"], r["bucket"]): r["n"] for r in long.groupBy("series", "bucket").agg(F.count("*").alias("n")).collect()}
    table = []
    for i, (b, heavy) in enumerate(bounds):
        above = 0
        for k in range(len(b) - 2, -1, -1):
            table.append((i, k, above, b[k] in heavy))
            above += counts.get((i, k), 0)
    offsets = F.broadcast(spark.createDataFrame(table, "series int, bucket int, above long, heavy boolean"))
    placed = long.join(offsets, ["series", "bucket"])
    inside = Window.partitionBy("series", "bucket").orderBy(F.col("value").desc())
    alone = placed.where("heavy").select("__id", "series", (F.col("above") + 1).alias("rank"))
    others = placed.where("not heavy").select("__id", "series", (F.col("above") + F.rank().over(inside)).alias("rank"))
    return alone.unionByName(others).withColumnRenamed("__id", item_id)


def fuse_rankings(items: DataFrame, item_id: str, scores: list[str], constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion: sum over the scores of 1 / (constant + rank).

    Only ranks enter, so a score's unit, range or outliers don't matter. A null
    or NaN score adds nothing; an item without any score gets 0 and comes last.
    Ties in a score share its smallest rank; ties in the sum share ``position``.
    Items need a non-null id; of repeated ids the row with the largest scores counts.
    Empty input gives no rows; other columns are ignored. Returns ``item_id``,
    ``fused`` (the sum in units of 1e-18, exact) and ``position`` from 1.
    """
    one = latest_rows(items, item_id, [], scores)
    table = materialize(one, "fusion-items")
    ranks = add_ranks(table, item_id, scores)
    part = F.floor(F.lit(SCALE) / (F.col("rank") + F.lit(constant))).cast("long")
    nothing = table.select(item_id, F.lit(0).cast("long").alias("part"))
    fused = ranks.select(item_id, part.alias("part")).unionByName(nothing).groupBy(item_id).agg(F.sum("part").alias("fused"))
    fused = materialize(fused, "fusion-sums")
    # doubles would merge close sums: rank the high and low digits as one exact order
    order = add_ranks_exact(fused, item_id, "fused")
    return fused.join(order, item_id).select(item_id, "fused", "position")


def add_ranks_exact(items: DataFrame, item_id: str, score: str) -> DataFrame:
    """As ``add_ranks`` for one long score whose digits exceed a double's."""
    spark = items.sparkSession
    n = items.count()
    buckets = max(16, min(4096, -(-n // 50_000)))
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    coarse = F.col(score).cast("double")
    bounds, heavy = _splits(items.agg(F.percentile_approx(coarse, cuts, F.lit(8 * buckets)).alias("q")).first()["q"])
    rows = items.select(F.col(item_id).alias("__id"), F.col(score).alias("value"), coarse.alias("__c"))
    placed = Bucketizer(splits=bounds, inputCol="__c", outputCol="__b", handleInvalid="keep").transform(rows)
    placed = placed.select("__id", "value", F.col("__b").cast("int").alias("bucket"))
    counts = {r["bucket"]: (r["n"], r["lo"] == r["hi"]) for r in placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    table, above = [], 0
    for k in range(len(bounds) - 2, -1, -1):
        size, same = counts.get(k, (0, True))
        table.append((k, above, same))
        above += size
    placed = placed.join(F.broadcast(spark.createDataFrame(table, "bucket int, above long, same boolean")), "bucket")
    inside = Window.partitionBy("bucket").orderBy(F.col("value").desc())
    alone = placed.where("same").select("__id", (F.col("above") + 1).alias("position"))
    others = placed.where("not same").select("__id", (F.col("above") + F.rank().over(inside)).alias("position"))
    return alone.unionByName(others).withColumnRenamed("__id", item_id)


def picture_scores(metrics: DataFrame, scores: list[str]) -> DataFrame:
    """A picture's latest scan with its scores."""
    return latest_rows(metrics, "image_id", ["scanned_at", "ingested_at"], scores)
