"""Exact quantiles of any number of rows, without one task that sees them all."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.storage import materialize

#: Values of one series that are brought to the driver at most, as (value, count); more are narrowed down first.
FEW = 50_000
STEPS = 200


def exact_quantiles(long: DataFrame, share: float) -> dict:
    """The quantile of ``value`` (double) for every ``series``, linear between neighbours as in ``percentile``.

    Rows with a null are left out. A sketch brackets the quantile, exact counts say how many values
    lie below the bracket, and the bracket is narrowed, about a hundredfold a round, until
    few values are left in it, which are counted and looked at. All aggregates are combined on
    the map side. Series are a handful (metrics, dimensions). No rows give an empty result.
    """
    spark = long.sparkSession
    rows = materialize(long.select("series", F.col("value").cast("double").alias("value")).where("series is not null and value is not null"), "quantiles")
    state = {r["series"]: [-math.inf, math.inf, 0, r["n"]] for r in rows.groupBy("series").agg(F.count("*").alias("n")).collect()}
    place = {k: share * (n - 1) for k, (*_, n) in state.items()}
    kind = rows.schema["series"].dataType.simpleString()

    def inside(bounds: dict) -> DataFrame:
        table = spark.createDataFrame([(k, float(v[0]), float(v[1])) for k, v in bounds.items()], f"series {kind}, lo double, hi double")
        return rows.join(F.broadcast(table), "series")

    while open_ := {k: v for k, v in state.items() if v[3] > FEW and v[0] < v[1]}:
        grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
        cuts = {r["series"]: r["q"] for r in inside(open_).where("value >= lo and value <= hi").groupBy("series").agg(F.percentile_approx("value", grid, F.lit(100 * STEPS)).alias("q")).collect()}
        tried = {}
        for k, (_, _, below, n) in open_.items():
            at = (place[k] - below) / n * STEPS
            tried[k] = (cuts[k][max(0, math.floor(at) - 1)], cuts[k][min(STEPS, math.ceil(at) + 1)])
        counted = inside(tried).groupBy("series").agg(F.count_if(F.col("value") < F.col("lo")).alias("below"), F.count_if(F.col("value").between(F.col("lo"), F.col("hi"))).alias("n"))
        moved = False
        for r in counted.collect():
            k = r["series"]
            if r["below"] <= math.floor(place[k]) and math.ceil(place[k]) < r["below"] + r["n"] and r["n"] < state[k][3]:
                state[k], moved = [*tried[k], r["below"], r["n"]], True
        if not moved:
            break
    few: dict = {}
    for r in inside(state).where("value >= lo and value <= hi").groupBy("series", "value").agg(F.count("*").alias("n")).collect():
        few.setdefault(r["series"], []).append((r["value"], r["n"]))
    out = {}
    for k, counts in few.items():
        at, upto, ends = place[k], state[k][2], []
        for value, n in sorted(counts):
            upto += n
            while len(ends) < 2 and upto > (math.floor(at), math.ceil(at))[len(ends)]:
                ends.append(value)
        part = at - math.floor(at)
        out[k] = ends[0] if part == 0 or ends[0] == ends[1] else (math.ceil(at) - at) * ends[0] + part * ends[1]
    return out
