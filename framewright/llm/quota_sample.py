"""Problem 2: a sample that follows target shares, with floors and a report."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.storage import materialize

MAX_TARGETS = 100_000
HASH_CELLS = 1 << 30


def tidy_label(label: Column) -> Column:
    """Lower case, no outer blanks, inner blanks and underscores as hyphens."""
    return F.regexp_replace(F.lower(F.regexp_replace(label, r"^[\s ]+|[\s ]+$", "")), r"[\s _]", "-")


def largest_remainder(total: int, shares: list[Fraction]) -> list[int]:
    """Whole quotas adding up to ``total``; ties of remainders go to the earlier cell."""
    whole = sum(shares)
    if not shares or whole <= 0 or total <= 0:
        return [0] * len(shares)
    exact = [total * s / whole for s in shares]
    quota = [int(x) for x in exact]
    order = sorted(range(len(shares)), key=lambda i: (quota[i] - exact[i], i))
    for i in order[: total - sum(quota)]:
        quota[i] += 1
    return quota


def allocate(total: int, shares: list[Fraction], floors: list[int], available: list[int]) -> list[int]:
    """Largest-remainder quotas, at least the floor and at most what is available.

    What capped cells cannot take goes to the open cells by their shares, and
    what floors add is taken from cells above their floor, until the quotas add
    up to ``total`` or every cell stands at its bound.
    """
    low = [min(f, a) for f, a in zip(floors, available)]
    quota = [min(max(q, lo), a) for q, lo, a in zip(largest_remainder(total, shares), low, available)]
    while (gap := total - sum(quota)) != 0:
        room = [i for i in range(len(quota)) if (quota[i] < available[i] and shares[i] > 0 if gap > 0 else quota[i] > low[i])]
        if not room:
            break
        step = largest_remainder(abs(gap), [shares[i] if gap > 0 else Fraction(quota[i] - low[i]) for i in room])
        before = sum(quota)
        for i, s in zip(room, step):
            quota[i] = min(quota[i] + s, available[i]) if gap > 0 else max(quota[i] - s, low[i])
        if sum(quota) == before:
            break
    return quota


def assigned(members: DataFrame, asked: dict[int, int]) -> DataFrame:
    """Every picture with one of its targets.

    Pictures of the same several targets are split by a hash in the shares of what
    these targets still lack of what they ask, sets of fewer targets first; where
    none lacks anything, they go to the smallest id. At most ``MAX_TARGETS`` different
    sets are read to the driver, after a check.
    """
    sets = materialize(members.groupBy("image_id").agg(F.sort_array(F.collect_set("target_id")).alias("__t")), "quota-sets")
    shared = sets.where(F.size("__t") > 1).groupBy("__t").agg(F.count("*").alias("n")).limit(MAX_TARGETS + 1).collect()
    if len(shared) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} sets of targets that share pictures")
    single_sets = sets.where(F.size("__t") == 1).select("image_id", F.col("__t")[0].alias("target_id"))
    if not shared:
        return single_sets
    single = {r["t"]: r["n"] for r in single_sets.groupBy(F.col("target_id").alias("t")).agg(F.count("*").alias("n")).collect()}
    lack = {t: Fraction(max(0, a - single.get(t, 0))) for t, a in asked.items()}
    cuts = []
    for row in sorted(shared, key=lambda x: (len(x["__t"]), x["__t"])):
        whole, upto = sum(lack[t] for t in row["__t"]), Fraction(0)
        share = {t: lack[t] / whole if whole else Fraction(t == row["__t"][0]) for t in row["__t"]}
        for t in row["__t"]:
            cuts.append((row["__t"], t, int(upto * HASH_CELLS), int((upto + share[t]) * HASH_CELLS)))
            upto, lack[t] = upto + share[t], max(Fraction(0), lack[t] - row["n"] * share[t])
    plan = members.sparkSession.createDataFrame(cuts, f"__t {dict(sets.dtypes)['__t']}, target_id int, __from long, __to long")
    cell = F.pmod(F.xxhash64("image_id", F.lit(41)), F.lit(HASH_CELLS))
    split = sets.where(F.size("__t") > 1).withColumn("__h", cell).join(F.broadcast(plan), "__t").where("__h >= __from and __h < __to")
    return single_sets.unionByName(split.select("image_id", "target_id"))


def quota_plan(cells: DataFrame, targets: DataFrame, one_in: int) -> tuple[DataFrame, DataFrame]:
    """Counts pictures per target and allots quotas; returns (members, report).

    ``cells`` has ``image_id``, ``composition`` and ``year`` of every scan;
    ``targets`` has ``target_id``, ``composition``, ``year``, ``target_permille``
    and ``min_rows``. The sample is ``floor(pictures / one_in)`` pictures.

    Rows with a null id are no pictures; a null year matches only a null year and
    a null composition only a null one; a picture seen with several
    compositions or years is available to each such target but is assigned to one
    (see ``assigned``), and quotas go by what is assigned; repeated rows count once. With no
    pictures every target is reported with its shortfall; with no targets both
    results are empty. The targets are a plan written by hand, so they are
    read to the driver, after a check that there are at most ``MAX_TARGETS``.

    members: ``image_id``, ``target_id``. report: ``target_id``, ``wanted``,
    ``available``, ``quota``, ``shortfall``.
    """
    spark = cells.sparkSession
    plan = targets.select("target_id", "composition", "year", "target_permille", "min_rows").where("target_id is not null").limit(MAX_TARGETS + 1).collect()
    if len(plan) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    plan = sorted({r["target_id"]: r for r in plan}.values(), key=lambda r: r["target_id"])
    wanted = targets.select("target_id", tidy_label(F.col("composition")).alias("__c"), F.col("year").cast("int").alias("__y")).where("target_id is not null").dropDuplicates(["target_id"])
    seen = cells.select("image_id", tidy_label(F.col("composition")).alias("c"), F.col("year").cast("int").alias("y")).where("image_id is not null")
    seen = seen.join(F.broadcast(wanted), F.col("c").eqNullSafe(F.col("__c")) & F.col("y").eqNullSafe(F.col("__y")), "left")
    members = materialize(seen.select("image_id", "target_id").distinct(), "quota-members")
    pictures = members.select("image_id").distinct().count()
    have = {r["target_id"]: r["n"] for r in members.where("target_id is not null").groupBy("target_id").agg(F.count("*").alias("n")).collect()}
    size = pictures // one_in
    shares = [Fraction(max(0, r["target_permille"] or 0), 1000) for r in plan]
    floors = [max(0, r["min_rows"] or 0) for r in plan]
    available = [have.get(r["target_id"], 0) for r in plan]
    asked = [max(f, -((-s.numerator * size) // s.denominator)) for f, s in zip(floors, shares)]
    members = assigned(members.where("target_id is not null"), {r["target_id"]: w for r, w in zip(plan, asked)})
    own = {r["target_id"]: r["n"] for r in members.groupBy("target_id").agg(F.count("*").alias("n")).collect()}
    quota = allocate(size, shares, floors, [own.get(r["target_id"], 0) for r in plan])
    rows = [(r["target_id"], w, a, q, max(0, w - a)) for r, w, a, q in zip(plan, asked, available, quota)]
    report = spark.createDataFrame(rows, "target_id int, wanted long, available long, quota long, shortfall long")
    return members, report


def draw_sample(members: DataFrame, report: DataFrame, seed: int = 17, key_buckets: int = 1024) -> DataFrame:
    """The quota's number of smallest random keys of every target.

    Random keys are hashes of the picture id, so a draw can be repeated. Keys
    are spread evenly, so counts per (target, key bucket) tell which buckets are
    taken whole; only the bucket where the quota ends is ranked. A target with a
    third of all pictures is thereby ranked in pieces of 1 / ``key_buckets``.
    """
    buckets = F.lit(key_buckets)
    drawn = members.groupBy("image_id").agg(F.min("target_id").alias("target_id"))
    keyed = drawn.withColumn("__key", F.xxhash64("image_id", F.lit(seed))).withColumn("__b", F.pmod(F.shiftrightunsigned("__key", 20), buckets).cast("int"))
    keyed = materialize(keyed, "quota-keys")
    counts = keyed.groupBy("target_id", "__b").agg(F.count("*").alias("__n"))
    upto = Window.partitionBy("target_id").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bounds = counts.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0))).join(F.broadcast(report.select("target_id", "quota")), "target_id")
    bounds = bounds.where("__before < quota").select("target_id", "__b", (F.col("quota") - F.col("__before")).alias("__left"), (F.col("__before") + F.col("__n") <= F.col("quota")).alias("__whole"))
    near = keyed.join(bounds, ["target_id", "__b"])
    whole = near.where("__whole").select("image_id", "target_id")
    order = Window.partitionBy("target_id").orderBy("__key", "image_id")
    edge = near.where("not __whole").withColumn("__r", F.row_number().over(order)).where("__r <= __left").select("image_id", "target_id")
    return whole.unionByName(edge)
