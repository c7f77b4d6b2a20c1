"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import hot_bound, skew_join
from framewright.storage import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour (or self) of every node and its number of pairs; combined on the map side."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), "u").alias("m"), F.count("*").alias("n"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, bound: int | None) -> DataFrame:
    both = _both_ways(edges)
    return _with_smallest(both, _smallest(both), bound).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, bound: int | None) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    moved = _with_smallest(down, low, bound).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _with_smallest(pairs: DataFrame, low: DataFrame, bound: int | None) -> DataFrame:
    """Pairs with ``m`` of their ``u``; if a node has more than ``bound`` pairs, the ``m`` of such nodes is broadcast."""
    return skew_join(pairs, low, ["u"], "n", bound) if bound else pairs.join(low.drop("n"), "u")


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of every linked node.

    ``links`` has the long columns ``u`` and ``v``; nulls and self-links are
    dropped, repeats count once, an empty table gives no rows. Each round is
    written to the shared folder, so lineage stays short and lost executors
    cost one round; rounds grow with the logarithm of a component's width. The hub
    of a large component is no hot key: what its pairs are joined with is broadcast.
    """
    edges = materialize(links.select("u", "v").where("u is not null and v is not null and u <> v").distinct(), "links")
    before = None
    while True:
        degree = _both_ways(edges).groupBy("u").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"))
        mark = degree.agg(F.sum("n"), F.expr("bit_xor(x)"), F.max("n")).first()
        if mark == before or not mark[0]:
            break
        before = mark
        bound = hot_bound(mark[0])
        bound = bound if mark[2] > bound else None
        edges = materialize(_small_star(_large_star(edges, bound), bound), "stars")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
