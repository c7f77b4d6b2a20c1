"""Rank fusion, quota sampling and top N per group against plain Python."""

import random
from fractions import Fraction

import pytest

from framewright.llm import quota_sample, rank_fusion, top_n

NAN, INF = float("nan"), float("inf")


def fused_by_hand(rows, constant=60):
    best = {}
    for key, *scores in rows:
        if key is not None:
            best.setdefault(key, scores)
    sums = {k: 0 for k in best}
    for i in range(len(rows[0]) - 1):
        values = {k: s[i] for k, s in best.items() if s[i] is not None and s[i] == s[i]}
        for k, v in values.items():
            rank = 1 + sum(o > v for o in values.values())
            sums[k] += int(1e18 / (constant + rank))
    return {k: (s, 1 + sum(o > s for o in sums.values())) for k, s in sums.items()}


@pytest.mark.parametrize("seed", range(3))
def test_fusion_against_hand(spark, seed):
    r = random.Random(seed)
    pick = lambda: r.choice([None, NAN, INF, -INF, 0.0, -0.0, 0.0, 1e9, r.random(), r.random(), r.randint(0, 3) * 1.0])
    rows = [(i, pick(), pick()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = {x["id"]: (x["fused"], x["position"]) for x in rank_fusion.fuse_rankings(df, "id", ["a", "b"]).collect()}
    assert got == fused_by_hand(rows)


def test_hot_values_get_exact_ranks(spark):
    rows = [(i, 5.0 if i % 3 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s double")
    got = {x["id"]: x["rank"] for x in rank_fusion.add_ranks(df, "id", ["s"], rows_per_bucket=50).collect()}
    order = sorted((s for _, s in rows), reverse=True)
    first = {}
    for place, s in enumerate(order, 1):
        first.setdefault(s, place)
    assert got == {i: first[s] for i, s in rows}


def test_fusion_of_odd_tables(spark):
    schema = "id long, a double, bucket int, series int, rank int, fused long"
    assert rank_fusion.fuse_rankings(spark.createDataFrame([], schema), "id", ["a"]).count() == 0
    rows = [(None, 1.0, 1, 1, 1, 1), (1, None, 1, 1, 1, 1), (1, None, 2, 2, 2, 2), (2, NAN, 1, 1, 1, 1)]
    got = rank_fusion.fuse_rankings(spark.createDataFrame(rows, schema), "id", ["a"]).collect()
    assert sorted((r["id"], r["fused"], r["position"]) for r in got) == [(1, 0, 1), (2, 0, 1)]


def test_one_large_scale_does_not_dominate(spark):
    rows = [(i, float(i), (10.0 - i) * 1e9) for i in range(11)]
    got = rank_fusion.fuse_rankings(spark.createDataFrame(rows, "id long, a double, b double"), "id", ["a", "b"]).collect()
    by = {r["id"]: r["fused"] for r in got}
    assert all(by[i] == by[10 - i] for i in range(11))


def test_largest_remainder():
    assert quota_sample.largest_remainder(10, [Fraction(1, 3)] * 3) == [4, 3, 3]
    assert quota_sample.largest_remainder(0, [Fraction(1)]) == [0] and quota_sample.largest_remainder(5, []) == []
    assert quota_sample.largest_remainder(5, [Fraction(0), Fraction(0)]) == [0, 0]


@pytest.mark.parametrize("seed", range(20))
def test_allocation_keeps_its_bounds(seed):
    r = random.Random(seed)
    n = r.randint(1, 12)
    shares, floors, have = [Fraction(r.randint(0, 9), 10) for _ in range(n)], [r.randint(0, 5) for _ in range(n)], [r.randint(0, 40) for _ in range(n)]
    total = r.randint(0, 100)
    quota = quota_sample.allocate(total, shares, floors, have)
    assert all(min(f, a) <= q <= a for q, f, a in zip(quota, floors, have))
    open_cells = [i for i in range(n) if quota[i] < have[i] and shares[i] > 0]
    if sum(quota) < total:
        assert not open_cells
    if sum(quota) > total:
        assert all(quota[i] == min(floors[i], have[i]) for i in range(n))


TARGETS = "target_id int, composition string, year int, target_permille int, min_rows int, image_id int"


def test_quota_sample(spark):
    cells = [(i, ["close-up", " Close_Up", "CLOSE UP"][i % 3], 2020) for i in range(60)] + [(100 + i, "medium", None) for i in range(40)] + [(None, "medium", None), (1, "close-up", 2020), (900, None, 2020)]
    df = spark.createDataFrame(cells, "image_id long, composition string, year int").selectExpr("*", "'x' as target_id", "1 as quota")
    targets = spark.createDataFrame([(1, "close-up", 2020, 600, 2, 0), (2, "medium", None, 300, 2, 0), (3, "full-body", 2020, 100, 4, 0)], TARGETS)
    members, report = quota_sample.quota_plan(df, targets, one_in=5)
    rows = {r["target_id"]: (r["wanted"], r["available"], r["quota"], r["shortfall"]) for r in report.collect()}
    assert rows == {1: (12, 60, 13, 0), 2: (6, 40, 7, 0), 3: (4, 0, 0, 4)}
    drawn = quota_sample.draw_sample(members, report).collect()
    assert len({r["image_id"] for r in drawn}) == len(drawn) == 20
    assert sorted(r["target_id"] for r in drawn).count(1) == 13
    again = quota_sample.draw_sample(*quota_sample.quota_plan(df, targets, one_in=5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, drawn))
    few = quota_sample.draw_sample(members, report, key_buckets=2).collect()
    assert sorted(r["target_id"] for r in few).count(1) == 13


def test_pictures_of_several_targets_fill_the_quotas(spark):
    """Each picture belongs to one target before quotas are given out, so that all of them can be drawn."""
    rows = [(i, c, 2020) for i in range(40) for c in ("a", "b")] + [(i, "c", 2020) for i in range(100, 160)]
    cells = spark.createDataFrame(rows, "image_id long, composition string, year int")
    targets = spark.createDataFrame([(1, "a", 2020, 300, 0, 0), (2, "b", 2020, 300, 0, 0), (3, "c", 2020, 400, 0, 0)], TARGETS)
    members, report = quota_sample.quota_plan(cells, targets, one_in=2)
    quota = {r["target_id"]: r["quota"] for r in report.collect()}
    assert [r["available"] for r in report.orderBy("target_id").collect()] == [40, 40, 60] and sum(quota.values()) == 50
    drawn = quota_sample.draw_sample(members, report).collect()
    assert len({r["image_id"] for r in drawn}) == len(drawn) == 50
    assert {t: sum(r["target_id"] == t for r in drawn) for t in quota} == quota and min(quota.values()) >= 10


def test_quota_sample_of_empty_tables(spark):
    cells = spark.createDataFrame([], "image_id long, composition string, year int")
    targets = spark.createDataFrame([(1, "a", 2020, 1000, 3, 0)], TARGETS)
    members, report = quota_sample.quota_plan(cells, targets, 20)
    assert [tuple(r) for r in report.collect()] == [(1, 3, 0, 0, 3)] and quota_sample.draw_sample(members, report).count() == 0
    members, report = quota_sample.quota_plan(spark.createDataFrame([(1, "a", 2020)], cells.schema), targets.limit(0), 20)
    assert report.count() == 0 and quota_sample.draw_sample(members, report).count() == 0


@pytest.mark.parametrize("subgroups", [1, 7])
def test_top_n_against_hand(spark, subgroups):
    r = random.Random(subgroups)
    rows = [(r.choice(["a", "b", None]), r.choice([1, None]), i % 90, r.choice([None, NAN, INF, 1.0, 2.0, 3.0, r.random()])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, y int, id long, s double").selectExpr("*", "1 as rank", "'c' as __rank2")
    got = {tuple(x) for x in top_n.top_n_per_group(df, ["g", "y"], "s", "id", 3, subgroups).collect()}
    want = set()
    for key in {x[:2] for x in rows}:
        items = sorted({(-s, i) for g, y, i, s in rows if (g, y) == key and s is not None and s == s})[:3]
        want |= {(*key, i, -s, k) for k, (s, i) in enumerate(items, 1)}
    assert got == want


def test_top_n_of_latest_scans(spark):
    schema = "image_id long, trigger_word string, year int, total_score double, scanned_at timestamp, ingested_at timestamp"
    sql = "select * from values (1L,'a',1,0.9D,timestamp'2024-01-01',timestamp'2024-01-01'),(1L,'a',1,0.1D,timestamp'2024-01-02',timestamp'2024-01-02'),(2L,'a',1,null,timestamp'2024-01-03',null),(2L,'a',1,0.5D,timestamp'2024-01-01',null),(3L,null,null,0.3D,null,null) as t(image_id,trigger_word,year,total_score,scanned_at,ingested_at)"
    df = spark.sql(sql)
    got = {tuple(r) for r in top_n.top_n_per_group(top_n.latest_scores(df), ["trigger_word", "year"], "total_score", "image_id", 3).collect()}
    assert got == {("a", 1, 1, 0.1, 1), (None, None, 3, 0.3, 1)}
    empty = spark.createDataFrame([], schema)
    assert top_n.top_n_per_group(top_n.latest_scores(empty), ["trigger_word"], "total_score", "image_id", 3).count() == 0
