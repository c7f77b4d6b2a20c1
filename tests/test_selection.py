"""Ranking, selection and refinement."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import filters, quantiles, ranking, refinement, selection

POOL = "path string, place int, composition string, year int, head_pose string, feature_vector array<double>"


def pool(spark, rows):
    return spark.createDataFrame(rows, POOL)


def zeros(n):
    return [0.0] * n


def one_hot(i, n):
    return [float(j == i) for j in range(n)]


def test_exact_quotas_on_zero_vectors(spark):
    comps = ["close-up"] * 20 + ["medium"] * 20 + ["full-body"] * 10
    rows = [(f"p{i}", i, c, None, None, zeros(16)) for i, c in enumerate(comps)]
    turns = selection.diverse_selection(pool(spark, rows), 30)
    by = {r["path"]: r["turn"] for r in turns.collect()}
    counts = [sum(comps[int(p[1:])] == c for p in by) for c in ("close-up", "medium", "full-body")]
    assert counts == [10, 14, 6] and by["p0"] == 1


def test_short_quota_is_filled_by_others(spark):
    comps = ["close-up"] * 25 + ["medium"] * 13 + ["full-body"] * 2
    rows = [(f"p{i}", i, c, None, None, zeros(16)) for i, c in enumerate(comps)]
    got = [comps[int(r["path"][1:])] for r in selection.diverse_selection(pool(spark, rows), 30).collect()]
    assert len(got) == 30 and got.count("full-body") == 2


def test_years_and_poses(spark):
    rows = [(f"p{i}", i, ("close-up", "medium", "full-body")[i % 3], 2020 + 2 * (i // 20), ("frontal", "three-quarter-left")[i % 2], one_hot(i % 50, 50)) for i in range(60)]
    got = [int(r["path"][1:]) // 20 for r in selection.diverse_selection(pool(spark, rows), 30).collect()]
    assert all(5 <= got.count(y) <= 15 for y in range(3))


def test_duplicates_before_selection_and_short_pools(spark):
    rows = [(f"p{i}", i, "medium", 2020, None, one_hot(i // 2, 8)) for i in range(8)]
    assert sorted(r["path"] for r in selection.diverse_selection(pool(spark, rows), 4).collect()) == ["p0", "p2", "p4", "p6"]
    assert selection.diverse_selection(pool(spark, rows), 10).count() == 8
    assert selection.diverse_selection(pool(spark, []), 10).count() == 0
    assert selection.diverse_selection(pool(spark, [("a", 1, None, None, None, None)]), 10).count() == 0


def test_greedy_dedup_is_no_chain(spark):
    angle = lambda d: [float(np.cos(d)), float(np.sin(d))]
    rows = [("a", 0, None, None, None, angle(0.0)), ("b", 1, None, None, None, angle(0.3)), ("c", 2, None, None, None, angle(0.6))]
    assert sorted(r["path"] for r in selection.greedy_dedup(pool(spark, rows), "path", "place", "feature_vector").collect()) == ["a", "c"]


def naive_quota(d, comps, years, poses, seats):
    """The same choice written as nested loops."""
    want, per_year = selection.composition_quota(seats), selection.year_quota([y for y in years if y is not None], seats)
    chosen = [0]
    while len(chosen) < min(seats, len(d)):
        tiers = {0: [], 1: [], 2: [], 3: []}
        for i in range(len(d)):
            if i in chosen:
                continue
            c_ok = comps[i] is not None and sum(comps[j] == comps[i] for j in chosen) < want.get(comps[i], 0)
            y_ok = years[i] is None or not per_year or sum(years[j] == years[i] for j in chosen) < per_year.get(years[i], 0)
            tiers[0 if c_ok and y_ok else 1 if c_ok else 2 if y_ok else 3].append(i)
        options = next(t for t in tiers.values() if t)
        far = [min(d[i, j] for j in chosen) * (1.05 if poses[i] and poses[i] not in [poses[j] for j in chosen] else 1) for i in options]
        chosen.append(options[int(np.argmax(far))])
    return chosen


@pytest.mark.parametrize("seed", range(4))
def test_quota_selection_against_loops(seed):
    rng, r = np.random.default_rng(seed), random.Random(seed)
    n = 60
    d = selection.distances(rng.normal(size=(n, 6)))
    comps = [r.choice(["close-up", "medium", "full-body", None]) for _ in range(n)]
    years = [r.choice([2018, 2019, 2020, None]) for _ in range(n)]
    poses = [r.choice(["frontal", "profile", None]) for _ in range(n)]
    assert selection.quota_farthest_first_places(d, comps, years, poses, 40) == naive_quota(d, comps, years, poses, 40)


def test_pool_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(selection, "MAX_POOL", 3)
    with pytest.raises(selection.PoolTooLarge):
        selection.greedy_dedup(pool(spark, [(f"p{i}", i, None, None, None, one_hot(0, 2)) for i in range(5)]), "path", "place", "feature_vector")


RECORD = "path string, ord int, composition string, year int, head_pose string, hands_truncated boolean, has_sunglasses boolean, sharpness double, face_sharpness double, exposure_score double, contrast double, colorfulness double, noise double, total_score double"


def record(path, ord_, **kw):
    base = dict(composition="medium", year=2024, head_pose=None, hands_truncated=False, has_sunglasses=False, sharpness=1.0, face_sharpness=1.0, exposure_score=1.0, contrast=1.0, colorfulness=1.0, noise=1.0, total_score=0.5)
    return tuple((base | kw | {"path": path, "ord": ord_})[c.split()[0]] for c in RECORD.split(", "))


def test_scores_and_adjustments(spark):
    rows = [record("plain", 0), record("glasses", 1, has_sunglasses=True), record("cut", 2, hands_truncated=True), record("front", 3, head_pose="frontal"), record("side", 4, head_pose="profile"), record("nan", 5, sharpness=float("nan"))]
    df = spark.createDataFrame(rows, RECORD)
    got = {r["path"]: r["total_score"] for r in ranking.scored(df).collect()}
    assert got["plain"] - got["glasses"] == pytest.approx(0.15) and got["plain"] - got["cut"] == pytest.approx(0.05)
    assert got["front"] - got["plain"] == pytest.approx(0.05) and got["plain"] - got["side"] == pytest.approx(0.05)
    assert got["plain"] - got["nan"] == pytest.approx(0.15)
    free = {r["path"]: r["total_score"] for r in ranking.scored(df, favor_no_glasses=False).collect()}
    assert free["glasses"] == free["plain"]


def test_ceilings_without_positive_values(spark):
    row = ranking.ceilings(spark.createDataFrame([record("a", 0, sharpness=0.0, noise=float("nan"))], RECORD)).first()
    assert row["ceil_sharpness"] == row["ceil_noise"] == 1.0


def test_temporal_strata_depend_on_input_order(spark):
    rows = [record(f"2024_{i}", i, year=2024) for i in range(30)] + [record(f"2018_{i}", 30 + i, year=2018) for i in range(10)]
    df = spark.createDataFrame(rows, RECORD)
    off = ranking.stratified_top_n(df, 10, temporal_balance=False).collect()
    on = ranking.stratified_top_n(df, 10).collect()
    assert {r["year"] for r in off} == {2024} and len(on) == 10
    assert sum(r["year"] == 2018 for r in on) >= 3


def naive_top_n(rows, top_n, balance):
    """The second pass over dicts, one step after the other."""
    rows = sorted(rows, key=lambda r: (-r["total_score"], r["ord"]))
    out = []
    if top_n >= 10:
        for comp, seats in ranking.composition_targets(top_n).items():
            same = [r for r in rows if (r["composition"] if r["composition"] in ranking.COMPOSITIONS else "medium") == comp]
            out += same[:seats][: top_n - len(out)]
    left = [r for r in rows if r not in out]
    years = list(dict.fromkeys(r["year"] for r in left))
    if balance and len(years) > 1:
        share = max(1, (top_n - len(out)) // len(years))
        for y in years:
            out += [r for r in left if r["year"] == y][:share][: top_n - len(out)]
    out += [r for r in rows if r not in out][: top_n - len(out)]
    return {r["path"] for r in out}


@pytest.mark.parametrize(("top_n", "balance"), [(5, True), (12, True), (40, True), (40, False), (200, True)])
def test_stratified_against_steps(spark, top_n, balance):
    r = random.Random(top_n)
    rows = [record(f"p{i}", i, composition=r.choice(["close-up", "medium", "full-body", "odd", None]), year=r.choice([2018, 2019, 2024, None]), total_score=r.choice([0.1, 0.4, 0.5, 0.9])) for i in range(120)]
    df = spark.createDataFrame(rows, RECORD)
    got = ranking.stratified_top_n(df, top_n, balance).collect()
    assert {x["path"] for x in got} == naive_top_n([x.asDict() for x in df.collect()], top_n, balance)
    assert sorted(x["place"] for x in got) == list(range(1, len(got) + 1))
    assert ranking.stratified_top_n(df.limit(0), top_n, balance).count() == 0


def judged(spark, rows):
    schema = "path string, place int, composition string, total_score double, feature_vector array<double>, turn int, v_single boolean, v_lighting string, v_sunglasses boolean, v_occlusion boolean"
    return spark.createDataFrame(rows, schema)


def seat(i, n, turn=None, single=True, lighting="Indoor", glasses=False, covered=False, score=None, comp="medium"):
    return (f"photo_{i}", i, comp, 0.5 + 0.01 * (n - i) if score is None else score, one_hot(i, n), turn, single, lighting, glasses, covered)


def paths(df):
    return {r["path"] for r in df.collect()}


def test_companions_are_replaced(spark):
    rows = [seat(i, 8, i + 1 if i < 4 else None, single=i != 1) for i in range(8)]
    got = paths(refinement.refine(judged(spark, rows)))
    assert len(got) == 4 and "photo_1" not in got


def test_sunglasses_are_swapped(spark):
    rows = [seat(i, 6, i + 1 if i < 3 else None, glasses=i == 1) for i in range(6)]
    got = paths(refinement.refine(judged(spark, rows), upto="faces"))
    assert len(got) == 3 and "photo_1" not in got


def test_exhausted_pool_drops_or_keeps(spark):
    rows = [seat(0, 2, 1, glasses=True), seat(1, 2, None, glasses=True)]
    assert paths(refinement.refine(judged(spark, rows), drop_sunglasses=True)) == set()
    assert len(paths(refinement.refine(judged(spark, rows)))) == 1


def test_lighting_is_rebalanced(spark):
    rows = [seat(i, 20, i + 1 if i < 10 else None, lighting="Indoor" if i < 10 else "Outdoor") for i in range(20)]
    got = {int(p[6:]) for p in paths(refinement.refine(judged(spark, rows), upto="lighting"))}
    assert len(got) == 10 and sum(i >= 10 for i in got) >= 3


def test_lift_and_outliers_keep_the_size(spark):
    rows = [seat(i, 12, i + 1 if i < 10 else None, score=0.1 * (i + 1)) for i in range(12)]
    got = paths(refinement.refine(judged(spark, rows)))
    assert len(got) == 10 and "photo_0" not in got
    assert refinement.refine(judged(spark, [])).count() == 0


def test_without_vectors_the_selection_stays(spark):
    rows = [("a", 1, "medium", 0.5, None, 1, True, "Indoor", False, False)]
    assert paths(refinement.refine(judged(spark, rows))) == {"a"}


def test_verdicts_are_fail_open(spark):
    records = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    verdicts = spark.sql("select * from values ('a', false, ' OUTDOOR ', true, null, timestamp_ntz'2024-01-02'), ('a', true, 'Indoor', false, true, timestamp_ntz'2024-01-01'), ('b', null, null, null, null, null) as t(path, is_single, lighting, has_sunglasses, has_face_occlusion, checked_at)")
    got = {r["path"]: tuple(r)[1:] for r in refinement.with_verdicts(records, verdicts).collect()}
    assert got == {"a": (False, "Outdoor", True, False), "b": (True, "Indoor", False, False), "c": (True, "Indoor", False, False)}


def test_era_window(spark):
    df = spark.createDataFrame([(2018,), (2020,), (2022,), (None,)], "year int")
    years = lambda w: sorted((r["year"] or 0) for r in filters.era_window(df, w).collect())
    assert years("2018-2020") == [2018, 2020] and years("2022") == [2022]
    assert years("1900-1950") == years("all") == years(None) == years("x-y") == [0, 2018, 2020, 2022]


def test_scan_order_and_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "path string")
    assert [(r["path"], r["ord"]) for r in filters.distinct_paths(df).orderBy("ord").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    assert filters.require_images(df, 2) == 4
    for rows, target in ((df, 30), (df.limit(0), 1)):
        with pytest.raises(filters.TooFewImages):
            filters.require_images(rows, target)


def test_consensus_outliers(spark):
    rows = [(f"p{i:02}", i, None, None, None, [1.0, 0.01 * i, 0.0]) for i in range(20)] + [("x", 20, None, None, None, [0.0, 0.0, 1.0])]
    assert [r["path"] for r in selection.consensus_outliers(pool(spark, rows), "path", "feature_vector").collect()] == ["x"]
    middle = {r["pos"]: r["value"] for r in selection.median_vector(pool(spark, rows), "feature_vector").collect()}
    assert middle == pytest.approx({0: 1.0, 1: float(np.median([0.01 * i for i in range(20)] + [0.0])), 2: 0.0})


def test_first_pass(spark):
    points = [(0.45, 0.3), (0.55, 0.3), (0.5, 0.35), (0.5, 0.4)]
    face = (0.9, 0.4, 0.2, 0.2, 0.25, points)
    schema = "path string, width int, height int, letterboxed boolean, faces array<struct<score:double,x:double,y:double,w:double,h:double,keypoints:array<struct<x:double,y:double>>>>, hands array<array<struct<x:double,y:double>>>"
    rows = [("ok", 1200, 1100, False, [face], None), ("small", 1000, 1100, False, [face], None), ("bars", 1200, 1100, True, [face], None), ("none", 1200, 1100, None, None, None), ("two", 1200, 1100, False, [face, face], None)]
    got = filters.first_pass(spark.createDataFrame(rows, schema)).collect()
    assert [(r["path"], r["composition"], r["head_pose"], r["hand_count"]) for r in got] == [("ok", "close-up", "frontal", 0)]
    assert tuple(got[0]["face_box"]) == (480, 220, 240, 275)


def test_top_n_floor():
    assert ranking.top_n_floor(60, 30) == 60 and ranking.top_n_floor(60, 50) == 100


@pytest.mark.parametrize(("few", "n"), [(50_000, 400), (20, 3000), (5, 1)])
def test_exact_quantiles(spark, monkeypatch, few, n):
    """Also when the bracket must be narrowed, with ties, a constant series and nulls."""
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(few)
    values = {"a": rng.normal(size=n) ** 3, "b": rng.integers(0, 4, n).astype(float), "c": np.full(n, 2.5)}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "series string, value double")
    for share in (0.5, 0.95):
        got = quantiles.exact_quantiles(df, share)
        assert got == pytest.approx({k: np.quantile(v, share) for k, v in values.items()})
    assert quantiles.exact_quantiles(df.limit(0), 0.5) == {}
