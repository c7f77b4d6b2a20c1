"""Problem 3: a varied subset, by max-sum dispersion over composable core-sets.

Look-alikes are first linked into groups, so that a group of any size enters
the selection as one candidate. Candidates are spread over partitions, each
partition keeps a core-set, and a local search over the united core-sets swaps members
while the total pairwise distance increases. The core-sets come from the same local search.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import vector_index as vi
from framewright.llm.common import skew_join
from framewright.llm.components import connected_components
from framewright.llm.quota_sample import largest_remainder, tidy_label
from framewright.storage import materialize

#: Candidates of one local search, about, and members it chooses at most; a larger subset is chosen in several parts.
CORE_ROWS = 20_000
MAX_SEATS = 5_000
#: Distances that are held at once.
CELLS = 4_000_000
#: What an unlike composition or head pose adds to the cosine distance of two candidates.
LABEL_WEIGHT = 0.25


def _join_roots(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merges the components of linked places; a label is the smallest place of its component."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        up = np.arange(len(labels))
        np.minimum.at(up, la, low)
        np.minimum.at(up, lb, low)
        while (up != up[up]).any():
            up = up[up]
        labels = up[labels]


def links_in_block(least: float):
    """Work for one block: links every vector to the first of its local component.

    All pairs are compared, but a component of m vectors leaves the block as
    m - 1 links, never as its pairs.
    """

    def work(qn: np.ndarray, qv: np.ndarray, bn: np.ndarray, bv: np.ndarray) -> pa.Table:
        nodes = np.unique(np.concatenate([qn, bn]))
        labels, qp, bp = np.arange(len(nodes)), np.searchsorted(nodes, qn), np.searchsorted(nodes, bn)
        for i in range(0, len(qn) if len(bn) else 0, 1024):
            r, c = np.nonzero(qv[i : i + 1024] @ bv.T > least)
            labels = _join_roots(labels, qp[i + r], bp[c])
        tied = np.flatnonzero(labels != np.arange(len(nodes)))
        return pa.table({"u": nodes[tied], "v": nodes[labels[tied]]})

    return work


def lookalike_groups(table: DataFrame, item_id: str, vector: str, dims: int, distance: float, probes: int = 16, margin: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Groups of items linked, directly or through others, by a cosine distance below ``distance``.

    Unusable vectors and null ids are left out, repeated rows count once,
    copies are one vector from the start; an empty table gives no rows. A pair
    is compared if either side routes to the other's part: one of its ``probes``
    most probable ones, within ``margin`` of the first. Returns (people, nodes): people with ``id``, ``node`` and
    ``label`` (its group), nodes with ``node``, ``q`` and ``label``.
    """
    packed = vi.packed_vectors(table, item_id, vector, dims)
    nodes = vi.distinct_vectors(packed, F.lit(1))
    links = vi.compared(nodes, dims, probes, margin, links_in_block(1.0 - distance), "u long, v long")
    tied = connected_components(links)
    labels = materialize(nodes.join(tied, "node", "left").select("node", "h1", "h2", "copies", F.coalesce("label", "node").alias("label")), "labels")
    people = materialize(vi.members(packed, labels, "label"), "people")
    return people, nodes.join(labels.select("node", "label"), "node").select("node", "q", "label")


def large_groups(people: DataFrame, least: int) -> DataFrame:
    """``id`` of the items in groups of at least ``least`` different items."""
    size = people.select("id", "label").distinct().groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return skew_join(people, size, ["label"], "n").select("id").distinct()


# ---- dispersion --------------------------------------------------------------------------------


def _features(rows: pd.DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = vi.unpack(pa.array(list(rows["q"]), pa.binary()), dims)
    return vectors, rows["composition"].to_numpy(), rows["head_pose"].to_numpy()


def _distance(at: int, vectors: np.ndarray, comp: np.ndarray, pose: np.ndarray) -> np.ndarray:
    """Distance of one candidate to all."""
    return 1 - vectors @ vectors[at] + LABEL_WEIGHT * (comp != comp[at]) + LABEL_WEIGHT * (pose != pose[at])


def _far_apart(size: int, f: tuple) -> list[int]:
    """Farthest-first places from the first on; ties go to the earlier."""
    chosen, near = [0], _distance(0, *f)
    near[0] = -1
    while len(chosen) < size:
        at = int(near.argmax())
        chosen.append(at)
        near = np.minimum(near, _distance(at, *f))
        near[at] = -1
    return chosen


def local_search(rows: pd.DataFrame, size: int, dims: int, least_gain: float = 1e-9) -> pd.DataFrame:
    """``size`` rows; swaps a selected and an unselected one while the sum of pairwise distances grows.

    Starts farthest-first. The member that adds least gives way as long as that
    raises the sum; then all pairs of a member and a candidate are tried, in blocks. The end is a
    local optimum: no swap raises the sum by the factor ``1 + least_gain``, which only keeps out
    rounding. Distances are in double precision; as the sum grows with every swap, no
    selection comes twice. Rows are taken in the order of their ids.
    """
    rows = rows.sort_values("id", kind="stable").reset_index(drop=True)
    if len(rows) <= size or size < 1:
        return rows[: max(0, size)] if size < 1 else rows
    vectors, *labels = _features(rows, dims)
    f = (vectors.astype("f8"), *labels)
    inside = np.zeros(len(rows), bool)
    inside[_far_apart(size, f)] = True
    total = np.zeros(len(rows))  # of each candidate, to all selected
    for i in np.flatnonzero(inside):
        total += _distance(int(i), *f)
    worth = total[inside].sum() / 2

    def swap(out: int) -> bool:
        """Swaps ``out`` for the best candidate, if that raises the sum."""
        nonlocal total, worth
        apart = _distance(out, *f)
        gain = np.where(inside, -np.inf, total - apart - total[out])
        new = int(gain.argmax())
        if gain[new] <= least_gain * max(worth, 1e-9):
            return False
        inside[out], inside[new] = False, True
        total = total - apart + _distance(new, *f)
        worth += gain[new]
        return True

    moved = True
    while moved:
        while swap(int(np.where(inside, total, np.inf).argmin())):
            pass
        moved, members = False, np.flatnonzero(inside)
        step = max(1, CELLS // len(rows))
        for i in range(0, len(members), step):
            block = members[i : i + step]
            apart = 1 - f[0][block] @ f[0].T + LABEL_WEIGHT * (f[1][block, None] != f[1]) + LABEL_WEIGHT * (f[2][block, None] != f[2])
            best = np.where(inside, -np.inf, total - apart).max(axis=1) - total[block]
            for out in block[np.argsort(-best)][np.sort(-best) < -least_gain * max(worth, 1e-9)].tolist():
                moved |= swap(out)
    return rows[inside]


def varied_subset(table: DataFrame, item_id: str, vector: str, composition: str, pose: str, size: int, dims: int, distance: float = 0.05) -> DataFrame:
    """``size`` items that spread over vectors, compositions and head poses.

    One candidate stands for each look-alike group: its smallest id. Labels are
    compared after tidying, null is a label of its own, the smallest label counts
    if an item has several. Items without a usable vector cannot be chosen. Fewer groups than
    ``size`` give one item each; an empty table gives none. Partitions are
    reduced again until one holds all core-sets, so no task takes more than about
    ``CORE_ROWS`` candidates, of which it keeps at most ``MAX_SEATS``: a larger subset is chosen in
    parts by a hash of the id, each with its share of the seats. Returns ``id``, ``composition``,
    ``head_pose`` and ``group_items`` (how many items it stands for).
    """
    people, nodes = lookalike_groups(table, item_id, vector, dims, distance)
    groups = people.groupBy("label").agg(F.min("id").alias("id"), F.countDistinct("id").alias("group_items"))
    first = nodes.where("node = label").select("label", "q")
    labels = table.select(F.col(item_id).cast("long").alias("id"), tidy_label(F.col(composition)).alias("c"), tidy_label(F.col(pose)).alias("p"))
    labels = labels.groupBy("id").agg(F.coalesce(F.min("c"), F.lit("")).alias("composition"), F.coalesce(F.min("p"), F.lit("")).alias("head_pose"))
    pool = materialize(groups.join(first, "label").join(labels, "id").select("id", "q", "composition", "head_pose", "group_items"), "candidates")
    n = pool.count()
    parts = max(1, -(-size // MAX_SEATS))
    pool = pool.withColumn("part", F.pmod(F.xxhash64("id", F.lit(23)), F.lit(parts)).cast("int"))
    schema, out = pool.schema, "id long, composition string, head_pose string, group_items long"
    have = {r["part"]: r["n"] for r in pool.groupBy("part").agg(F.count("*").alias("n")).collect()}
    order = sorted(have)
    seats = dict(zip(order, largest_remainder(min(size, n), [Fraction(have[k]) for k in order])))
    while have and max(have.values()) > CORE_ROWS:
        cells = F.broadcast(table.sparkSession.createDataFrame([(k, -(-have[k] // CORE_ROWS)) for k in order], "part int, cells long"))
        keyed = pool.join(cells, "part").withColumn("cell", F.pmod(F.xxhash64("id", F.lit(sum(have.values()))), F.col("cells")))
        pool = materialize(keyed.groupBy("part", "cell").applyInPandas(lambda rows: local_search(rows.drop(columns=["cell", "cells"]), seats[int(rows["part"].iloc[0])], dims)[schema.names], schema), "core-sets")
        have = {r["part"]: r["n"] for r in pool.groupBy("part").agg(F.count("*").alias("n")).collect()}
    best = pool.groupBy("part").applyInPandas(lambda rows: local_search(rows, seats[int(rows["part"].iloc[0])], dims)[["id", "composition", "head_pose", "group_items"]], out)
    return best.withColumnRenamed("id", item_id)
