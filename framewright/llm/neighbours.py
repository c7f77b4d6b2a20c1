"""Problem 4: the most similar vectors of every vector, by learned partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm import vector_index as vi
from framewright.llm.common import hot_bound
from framewright.storage import materialize

SCHEMA = "node long, other long, similarity float"


def best_in_block(k: int, least: float):
    """Work for one block: the k most similar stored vectors of every query, by exact comparison."""

    def work(qn: np.ndarray, qv: np.ndarray, bn: np.ndarray, bv: np.ndarray) -> pa.Table:
        found = [(np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "f4"))]
        for i in range(0, len(qn) if len(bn) else 0, 1024):
            sims = qv[i : i + 1024] @ bv.T
            sims[qn[i : i + 1024, None] == bn[None, :]] = -2
            if least > -1:
                r, c = np.nonzero(sims >= least)
                s = sims[r, c]
                order = np.lexsort((bn[c], -s, r))
                r, c, s = r[order], c[order], s[order]
                head = np.arange(len(r)) - np.searchsorted(r, r) < k
                r, c, s = r[head], c[head], s[head]
            else:
                take = min(k, sims.shape[1])
                c = np.argpartition(-sims, take - 1, axis=1)[:, :take] if take < sims.shape[1] else np.tile(np.arange(take), (len(sims), 1))
                r, c = np.repeat(np.arange(len(sims)), take), c.ravel()
                s = sims[r, c]
                r, c, s = r[s > -2], c[s > -2], s[s > -2]
            found.append((qn[i + r], bn[c], s))
        node, other, sim = (np.concatenate(x) for x in zip(*found))
        return pa.table({"node": node, "other": other, "similarity": sim.astype("f4")})

    return work


def most_similar(table: DataFrame, item_id: str, vector: str, dims: int, k: int, query: Column | None = None, probes: int | None = None, least: float = -1.0, margin: float = 5.0) -> DataFrame:
    """The ``k`` most similar other items (cosine) of every item that asks.

    Rows with unusable vectors (see ``packed_vectors``) or a null id neither
    ask nor are found; repeated rows count once; an item with several different
    vectors is compared by each. Equal similarities go to the smaller id.
    Exact copies of a vector are merged before the search and put back
    after it, each item linking to at most ``k`` others. ``query`` says which rows
    ask (all, if None), ``least`` leaves out less similar pairs, ``probes`` is
    the most parts that are asked (default: ``vector_index.default_probes``), of which those whose
    log-probability is more than ``margin`` below the highest are spared.
    An empty table gives no rows.

    Returns ``id``, ``other_id``, ``similarity`` (single precision) and ``rank``.
    """
    keep = F.lit(True) if query is None else query
    packed = vi.packed_vectors(table, item_id, vector, dims)
    asks = F.lit(1) if query is None else keep.cast("int")
    nodes = vi.distinct_vectors(packed, asks)
    near = vi.compared(nodes, dims, probes, margin, best_in_block(k, least), SCHEMA)
    order = Window.partitionBy("node").orderBy(F.col("similarity").desc(), "other")
    near = near.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).drop("__r")
    people = materialize(vi.members(packed, nodes), "members")
    # the k + 1 smallest ids of a vector stand for all its copies: nobody needs more of them
    few = people.withColumn("__r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("__r") <= k + 1).drop("__r")
    copies = few.select("node", F.col("node").alias("other"), F.lit(1.0).cast("float").alias("similarity")).groupBy("node", "other", "similarity").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    links = near.unionByName(copies).join(few.select(F.col("node").alias("other"), F.col("id").alias("other_id")), "other")
    askers = people if query is None else people.where(keep)
    pairs = _by_node(askers, links.select("node", "other_id", "similarity"), nodes).where("id <> other_id")
    pairs = pairs.groupBy("id", "other_id").agg(F.max("similarity").alias("similarity"))
    best = Window.partitionBy("id").orderBy(F.col("similarity").desc(), "other_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _by_node(askers: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Askers with the links of their vector. Links of vectors that very many rows share are broadcast:
    there are fewer than a thousand such vectors, with at most ``(k + 1) ** 2`` links each."""
    total, most = nodes.agg(F.sum("copies"), F.max("copies")).first()
    bound = hot_bound(total or 0)
    if (most or 0) <= bound:
        return askers.join(links, "node")
    hot = F.broadcast(nodes.where(F.col("copies") > bound).select("node"))
    few = askers.join(hot, "node").join(F.broadcast(links.join(hot, "node")), "node")
    return few.unionByName(askers.join(hot, "node", "left_anti").join(links.join(hot, "node", "left_anti"), "node"))
