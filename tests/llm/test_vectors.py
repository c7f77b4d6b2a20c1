"""Vector search, look-alike groups and the varied subset against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewright.llm import common, components, neighbours, varied_subset
from framewright.llm import vector_index as vi
from framewright.llm.components import connected_components

DIMS = 16
SCHEMA = "image_id long, feature_vector array<float>, composition string, head_pose string, node long, q int, label string"


def make(spark, rows):
    return spark.createDataFrame([(i, v, c, p, 1, 2, "x") for i, v, c, p in rows], SCHEMA)


@pytest.fixture(scope="module")
def cloud():
    """Loose points, tight groups of several sizes, copies and unusable vectors."""
    rng = np.random.default_rng(1)
    rows, k = [], 0
    for _ in range(1500):
        rows.append((k, rng.normal(size=DIMS) * rng.uniform(0.1, 50)))
        k += 1
    for size in (2, 5, 9, 10, 12, 40):
        centre = rng.normal(size=DIMS)
        for _ in range(size):
            rows.append((k, (centre + rng.normal(size=DIMS) * 0.08) * rng.uniform(0.5, 9)))
            k += 1
    copy = rng.normal(size=DIMS)
    for _ in range(15):
        rows.append((k, copy))
        k += 1
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    bad = [(k, None), (k + 1, [0.0] * DIMS), (k + 2, [1.0] * (DIMS - 1)), (k + 3, [float("nan")] * DIMS), (k + 4, [float("inf")] + [1.0] * (DIMS - 1)), (k + 5, []), (None, [1.0] * DIMS)]
    return good, bad


def table(spark, cloud):
    good, bad = cloud
    comps, poses = ["close-up", "medium", None], ["frontal", None]
    rows = [(i, v, comps[(i or 0) % 3], poses[(i or 0) % 2]) for i, v in good + bad + good[:50]]
    return make(spark, rows)


def unit(cloud):
    m = np.array([v for _, v in cloud[0]])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    monkeypatch.setattr(vi, "ROWS_PER_PART", 200)


def test_found_pairs_are_complete(spark, cloud):
    sims = unit(cloud) @ unit(cloud).T
    got = neighbours.most_similar(table(spark, cloud), "image_id", "feature_vector", DIMS, 10, probes=4, least=0.98).collect()
    pairs = {(r["id"], r["other_id"]) for r in got}
    for i in range(len(sims)):
        want = {j for j in np.flatnonzero(sims[i] >= 0.98) if j != i}
        have = {b for a, b in pairs if a == i}
        assert have <= {j for j in np.flatnonzero(sims[i] >= 0.9799) if j != i}
        assert len(have) == min(10, len(want)) if len(want) > 10 else have == want


def test_recall_of_search(spark, cloud):
    sims = unit(cloud) @ unit(cloud).T
    np.fill_diagonal(sims, -2)
    rows = neighbours.most_similar(table(spark, cloud), "image_id", "feature_vector", DIMS, 10, query=F.col("id") % 20 == 0).collect()
    by = {}
    for r in rows:
        by.setdefault(r["id"], []).append(r)
    asked = [i for i, _ in cloud[0] if i % 20 == 0]
    assert set(by) == set(asked) and all(sorted(r["rank"] for r in v) == list(range(1, 11)) for v in by.values())
    hits = sum(len({r["other_id"] for r in by[i]} & set(np.argsort(-sims[i], kind="stable")[:10])) for i in asked if i < 1578)
    assert hits / (10 * sum(i < 1578 for i in asked)) >= 0.9
    for i in asked:
        assert all(abs(r["similarity"] - sims[i, r["other_id"]]) < 1e-4 for r in by[i])


def test_large_parts_become_grids(spark, cloud, monkeypatch):
    plain = neighbours.most_similar(table(spark, cloud), "image_id", "feature_vector", DIMS, 5, probes=3, least=0.9).collect()
    monkeypatch.setattr(vi, "BLOCK_ROWS", 60)
    grid = neighbours.most_similar(table(spark, cloud), "image_id", "feature_vector", DIMS, 5, probes=3, least=0.9).collect()
    assert {(r["id"], r["other_id"]) for r in plain} == {(r["id"], r["other_id"]) for r in grid}


@pytest.mark.parametrize("shard_rows", [10**9, 700])
def test_two_levels_shards_and_hot_vectors(spark, cloud, monkeypatch, shard_rows):
    monkeypatch.setattr(vi, "FLAT_PARTS", 2)
    monkeypatch.setattr(vi, "ROWS_PER_PART", 100)
    monkeypatch.setattr(vi, "SHARD_ROWS", shard_rows)
    for module in (common, neighbours, components):
        monkeypatch.setattr(module, "hot_bound", lambda total: 8)
    sims = unit(cloud) @ unit(cloud).T
    got = {(r["id"], r["other_id"]) for r in neighbours.most_similar(table(spark, cloud), "image_id", "feature_vector", DIMS, 10, probes=12, least=0.98, margin=4.0).collect()}
    for i in range(len(sims)):
        want = {j for j in np.flatnonzero(sims[i] >= 0.98) if j != i}
        have = {b for a, b in got if a == i}
        assert len(have) == 10 if len(want) > 10 else have == want
    label = groups_by_hand(unit(cloud), 0.05)
    want = {i for i, _ in cloud[0] if label.count(label[i]) >= 10}
    people, _ = varied_subset.lookalike_groups(table(spark, cloud), "image_id", "feature_vector", DIMS, 0.05, margin=4.0)
    assert {r["id"] for r in varied_subset.large_groups(people, 10).collect()} == want


def groups_by_hand(m, distance):
    n, label = len(m), list(range(len(m)))
    near = 1 - m @ m.T < distance
    for i in range(n):
        stack = [i]
        while stack:
            a = stack.pop()
            for b in np.flatnonzero(near[a]):
                if label[b] > label[i]:
                    label[b] = label[i]
                    stack.append(b)
    return label


def test_large_lookalike_groups(spark, cloud):
    label = groups_by_hand(unit(cloud), 0.05)
    want = {i for i, _ in cloud[0] if label.count(label[i]) >= 10}
    people, _ = varied_subset.lookalike_groups(table(spark, cloud), "image_id", "feature_vector", DIMS, 0.05)
    assert {r["id"] for r in varied_subset.large_groups(people, 10).collect()} == want and len(want) >= 60


def test_varied_subset(spark, cloud):
    df = table(spark, cloud)
    chosen = varied_subset.varied_subset(df, "image_id", "feature_vector", "composition", "head_pose", 30, DIMS).collect()
    ids = [r["image_id"] for r in chosen]
    label = groups_by_hand(unit(cloud), 0.05)
    assert len(set(ids)) == 30 and len({label[i] for i in ids}) == 30
    rng = np.random.default_rng(0)
    spread = lambda x: (1 - unit(cloud)[x] @ unit(cloud)[x].T).sum()
    assert spread(ids) > max(spread(rng.choice(len(cloud[0]), 30, replace=False)) for _ in range(20))
    assert {r["composition"] for r in chosen} == {"close-up", "medium", ""}


@pytest.mark.parametrize("most", [5000, 7])
def test_subset_in_several_core_sets(spark, cloud, monkeypatch, most):
    monkeypatch.setattr(varied_subset, "CORE_ROWS", 100)
    monkeypatch.setattr(varied_subset, "MAX_SEATS", most)
    chosen = varied_subset.varied_subset(table(spark, cloud), "image_id", "feature_vector", "composition", "head_pose", 20, DIMS).collect()
    assert len(chosen) == 20


def test_local_search_only_improves():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(200, DIMS))
    rows = pd.DataFrame({"id": range(200), "q": [x.as_py() for x in vi.pack(m / np.linalg.norm(m, axis=1, keepdims=True))], "composition": ["a", "b"] * 100, "head_pose": [""] * 200, "group_items": 1})
    f = varied_subset._features(rows, DIMS)
    worth = lambda ids: sum(varied_subset._distance(i, *f)[list(ids)].sum() for i in ids) / 2
    start, best = varied_subset._far_apart(12, f), varied_subset.local_search(rows, 12, DIMS)
    assert len(best) == 12 and worth(best["id"]) >= worth(start)


def test_local_search_ends_where_no_swap_gains():
    rng = np.random.default_rng(4)
    m = rng.normal(size=(800, DIMS))
    rows = pd.DataFrame({"id": range(800), "q": [x.as_py() for x in vi.pack(m / np.linalg.norm(m, axis=1, keepdims=True))], "composition": ["a", "b"] * 400, "head_pose": ["", "x", "y", "z"] * 200, "group_items": 1})
    vectors, comp, pose = varied_subset._features(rows, DIMS)
    every = np.stack([varied_subset._distance(i, vectors.astype("f8"), comp, pose) for i in range(800)])
    inside = np.isin(np.arange(800), varied_subset.local_search(rows, 100, DIMS)["id"])
    total = every[inside].sum(axis=0)
    gain = total[None, ~inside] - every[inside][:, ~inside] - total[inside][:, None]
    assert inside.sum() == 100 and gain.max() < 1e-4


def test_empty_and_tiny_tables(spark):
    for rows in ([], [(1, None, None, None)], [(1, [1.0] * DIMS, "a", "b")]):
        df = make(spark, rows)
        assert neighbours.most_similar(df, "image_id", "feature_vector", DIMS, 10).count() == 0
        people, _ = varied_subset.lookalike_groups(df, "image_id", "feature_vector", DIMS, 0.05)
        assert varied_subset.large_groups(people, 2).count() == 0
        assert varied_subset.varied_subset(df, "image_id", "feature_vector", "composition", "head_pose", 5, DIMS).count() == len([r for r in rows if r[1]])
    pair = make(spark, [(1, [1.0] * DIMS, "a", "b"), (2, [2.0] * DIMS, "a", "b"), (2, [2.0] * DIMS, "a", "b")])
    assert sorted((r["id"], r["other_id"]) for r in neighbours.most_similar(pair, "image_id", "feature_vector", DIMS, 10).collect()) == [(1, 2), (2, 1)]


def test_packing_keeps_angles():
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 64))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    assert np.abs(vi.unpack(vi.pack(m), 64).astype("f8") @ m.T - m @ m.T).max() < 1e-4


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))] + [(i, i + 1) for i in range(200, 260)] + [(300, 300 + i) for i in range(1, 40)] + [(None, 1), (5, 5)]
    label = {}
    for a, b in edges:
        if a is not None and a != b:
            label.setdefault(a, a)
            label.setdefault(b, b)
    for _ in range(len(label)):
        changed = False
        for a, b in edges:
            if a is not None and a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == label
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
