"""Second pass: robust normalisation, composite score and stratified top n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.operators.quantiles import exact_quantiles
from framewright.schema import COMPOSITIONS

METRICS = ("sharpness", "face_sharpness", "contrast", "colorfulness", "noise")
# Weights of the composite score, adjustments and shares of the compositions.
WEIGHTS = {"sharpness": 0.15, "face_sharpness": 0.35, "exposure_score": 0.15, "contrast": 0.15, "colorfulness": 0.1, "noise": 0.1}
SHARES = {"close-up": 0.35, "medium": 0.45, "full-body": 0.20}
POSE_BONUS, POSE_MALUS, HANDS_MALUS, GLASSES_MALUS = 0.05, 0.05, 0.05, 0.15


def top_n_floor(top_n: int, target: int) -> int:
    return max(top_n, 2 * target)


def latest_records(metrics: DataFrame, key: str = "path") -> DataFrame:
    """One record per key: the latest scan, repeated deliveries once. The rank filter also runs before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.col("scanned_at").desc_nulls_last(), F.col("ingested_at").desc_nulls_last(), F.col("total_score").desc_nulls_last())
    return metrics.where(F.col(key).isNotNull()).withColumn("__r", F.row_number().over(newest)).where("__r = 1").drop("__r")


def number(metric: str) -> Column:
    """Metric without null or NaN (0 instead)."""
    c = F.col(metric)
    return F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)


def ceilings(records: DataFrame) -> DataFrame:
    """One row: per metric the exact 95th percentile of its positive numbers, 1 if there are none."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("series"), F.col(m).cast("double").alias("value")) for m in METRICS])).alias("x")
    found = exact_quantiles(records.select(*METRICS).select(each).select("x.*").where("value > 0 and not isnan(value)"), 0.95)
    return records.sparkSession.createDataFrame([tuple(found.get(m, 1.0) for m in METRICS)], ", ".join(f"ceil_{m} double" for m in METRICS))


def composite_score(records: DataFrame) -> DataFrame:
    """Adds ``base_score``: weighted metrics, each cut at its ceiling; exposure as it is, noise counts against."""
    rows = records.crossJoin(F.broadcast(ceilings(records)))
    unit = lambda m: F.least(F.lit(1.0), number(m) / F.col(f"ceil_{m}"))
    w = WEIGHTS
    score = w["sharpness"] * unit("sharpness") + w["face_sharpness"] * unit("face_sharpness") + w["exposure_score"] * number("exposure_score")
    score = score + w["contrast"] * unit("contrast") + w["colorfulness"] * unit("colorfulness") + w["noise"] * (1.0 - unit("noise"))
    return rows.withColumn("base_score", score).drop(*[f"ceil_{m}" for m in METRICS])


def adjustment(favor_no_glasses: bool = True) -> Column:
    """What pose, hands and glasses add to a score."""
    pose = F.when(F.col("head_pose").isin("frontal", "three-quarter-left", "three-quarter-right"), POSE_BONUS).when(F.col("head_pose") == "profile", -POSE_MALUS).otherwise(0.0)
    hands = F.when(F.col("hands_truncated"), -HANDS_MALUS).otherwise(0.0)
    glasses = F.when(F.col("has_sunglasses"), -GLASSES_MALUS).otherwise(0.0) if favor_no_glasses else F.lit(0.0)
    return pose + hands + glasses


def scored(records: DataFrame, favor_no_glasses: bool = True) -> DataFrame:
    """Records with ``total_score`` set from their metrics, to nine digits, so that ties are ties."""
    rows = composite_score(records)
    return rows.withColumn("total_score", F.round(F.col("base_score") + adjustment(favor_no_glasses), 9)).drop("base_score")


def composition_bin(composition: Column) -> Column:
    return F.when(composition.isin(*COMPOSITIONS), composition).otherwise("medium")


def composition_targets(top_n: int) -> dict[str, int]:
    return {c: max(1, int(top_n * s)) for c, s in SHARES.items()}


def stratified_top_n(records: DataFrame, top_n: int = 60, temporal_balance: bool = True, tie: str = "ord") -> DataFrame:
    """The best ``top_n`` records, with seats for compositions and years first.

    From 10 seats on, each composition (unknown ones count as medium) seats its best share.
    Then, if the others span several years (null is a year), each year seats its part of the free
    seats, years in order of their best record. The rest goes to the best left over. Ties by ``tie``.

    At most ``top_n`` records a composition and a year, and ``top_n`` more overall, can
    be seated; the first step keeps those with rank filters that also run before
    their shuffle, so that what is ranked as a whole is small however large the input is.
    Adds ``place`` from 1.
    """
    best = [F.col("total_score").desc_nulls_last(), F.col(tie)]
    rows = records.withColumn("__comp", composition_bin(F.col("composition")))
    per_comp = Window.partitionBy("__comp").orderBy(*best)
    targets = composition_targets(top_n) if top_n >= 10 else {}
    limit = F.lit(0)
    for name, seats in targets.items():
        limit = F.when(F.col("__comp") == name, seats).otherwise(limit)
    if targets:
        most = max(targets.values())
        heads = rows.withColumn("__rc", F.row_number().over(per_comp)).where(F.col("__rc") <= most).where(F.col("__rc") <= limit)
        order = F.when(F.col("__comp") == "close-up", 1).when(F.col("__comp") == "medium", 2).otherwise(3)
        first = heads.withColumn("__turn", F.row_number().over(Window.orderBy(order, "__rc"))).where(F.col("__turn") <= top_n).drop("__rc", "__turn")
        rest = rows.join(F.broadcast(first.select(tie)), tie, "left_anti")
    else:
        first, rest = rows.limit(0), rows
    # only the best top_n of each year can be seated from here on
    per_year = rest.withColumn("__ry", F.row_number().over(Window.partitionBy("year").orderBy(*best))).where(F.col("__ry") <= top_n)
    free = F.lit(top_n) - F.col("__taken")
    taken = F.broadcast(first.agg(F.count("*").cast("int").alias("__taken")))
    whole = Window.partitionBy(F.lit(0))
    pool = per_year.crossJoin(taken)
    pool = pool.withColumn("__rank", F.row_number().over(whole.orderBy(*best)))
    pool = pool.withColumn("__year_first", F.min("__rank").over(Window.partitionBy("year")))
    pool = pool.withColumn("__years", F.size(F.collect_set(F.coalesce(F.col("year").cast("string"), F.lit("-"))).over(whole)))
    share = F.greatest(F.lit(1), F.floor(free / F.col("__years")).cast("int"))
    seated = (F.col("__ry") <= share) & (F.col("__years") > 1) if temporal_balance else F.lit(False)
    pool = pool.withColumn("__stage", F.when(seated, 1).otherwise(2))
    turn = [F.col("__stage"), F.when(F.col("__stage") == 1, F.col("__year_first")), F.col("__rank")]
    pool = pool.withColumn("__turn", F.row_number().over(whole.orderBy(*turn))).where(F.col("__turn") <= free)
    chosen = first.unionByName(pool.select(*first.columns)).drop("__comp")
    return chosen.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*best)))
