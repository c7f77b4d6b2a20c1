"""Learned partitions for vector search.

A bounded sample gives a nearest-neighbour graph, the graph is cut into
balanced parts, and a small softmax classifier learns in which parts a vector's
neighbours lie. Every part is then cut in the same way, by a classifier of its
own that is fitted to a sample of its own on the executors, until parts hold about
``ROWS_PER_PART`` vectors whatever the size of the table. Every vector is stored
in its most probable leaf part, and sent as a query to several probable ones, where
it is compared exactly.

What is broadcast are the classifiers, ``dims`` numbers a part. A table of more than
``SHARD_ROWS`` vectors is first routed into shards on the shared folder, each with
classifiers of its own, so that neither broadcasts nor the driver grow with it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import skew_join
from framewright.storage import materialize

ROWS_PER_PART = 1200
#: Sample vectors a part is fitted to, and the least number of a whole sample.
SAMPLE_PER_PART, MIN_SAMPLE = 48, 4_000
#: Vectors that are indexed with one set of broadcast classifiers: about 80 MB of them at 64 dimensions.
SHARD_ROWS = 400_000_000
#: Parts of one classifier up to which no second level is needed.
FLAT_PARTS = 24
NEIGHBOURS = 10
#: Rows of one part that are stored together; larger parts are cut into a grid of such blocks.
BLOCK_ROWS = 20_000
LEVELS = 32767
#: Numbers of a product of matrices that are held at once on the driver.
CELLS = 4_000_000
#: By how much more than the margin the first level's choice may lie below the best.
SLACK = 1.0
#: Numbers of the parts of one part, at most.
WIDTH = 1 << 20

#: What a vector does in a block.
STORED, ASKS = 1, 2

Work = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.Table]


def usable_vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and unit-length rows (double) of the vectors with ``dims`` finite numbers, not all zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dims), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype("f8")
    rows = flat.reshape(-1, dims)
    good = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
    rows, at = rows[good], at[good]
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return at, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pack(rows: np.ndarray) -> pa.Array:
    """Directions as 16-bit whole numbers, two bytes a dimension; a cosine keeps an error below 1e-5."""
    levels = np.rint(rows / np.abs(rows).max(axis=1, keepdims=True) * LEVELS).astype("<i2")
    width = 2 * rows.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(levels), [None, pa.py_buffer(levels.tobytes())]).cast(pa.binary())


def unpack(column: pa.Array, dims: int) -> np.ndarray:
    """Unit-length rows (single precision) of packed directions."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, dims), "f4")
    raw = np.frombuffer(b"".join(column.to_pylist()), "<i2").reshape(-1, dims).astype("f4")
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def packed_vectors(table: DataFrame, item_id: str, vector: str, dims: int) -> DataFrame:
    """``id`` and packed direction ``q`` of every row with a usable vector and an id.

    Vectors that are null, of another length, all zero or with a number that
    is null, NaN or infinite are left out. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = usable_vectors(batch.column(1), dims)
            if len(at):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pack(rows)], ["id", "q"])

    rows = table.select(F.col(item_id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v")).where("id is not null and v is not null")
    return rows.mapInArrow(run, "id long, q binary")


# ---- model -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Router:
    """Linear softmax classifier over parts, and the share of vectors each part is expected to hold."""

    weights: np.ndarray
    bias: np.ndarray
    share: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.bias)

    def logs(self, rows: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of every part."""
        logits = rows @ self.weights + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def largest(values: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` largest numbers of every row, in any order."""
    return np.argpartition(-values, count - 1, axis=1)[:, :count] if count < values.shape[1] else np.tile(np.arange(values.shape[1]), (len(values), 1))


@dataclass(frozen=True)
class Tree:
    """A classifier over the table's parts and, for each part that is cut again, one over its own parts.

    A leaf has the number ``part * WIDTH + part of the part``.
    """

    top: Router
    below: dict[int, Router]

    def home(self, rows: np.ndarray) -> np.ndarray:
        """The most probable leaf of every row, level by level."""
        first = best_column(np.hstack([rows, np.ones((len(rows), 1), "f4")]), np.vstack([self.top.weights, self.top.bias]))
        leaf = first.astype("i8") * WIDTH
        for part in np.unique(first):
            if (router := self.below.get(int(part))) is not None:
                at = np.flatnonzero(first == part)
                leaf[at] += router.logs(rows[at]).argmax(axis=1)
        return leaf

    def probable(self, rows: np.ndarray, count: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of the at most ``count`` most probable leaves of every row, whose
        log-probability is within ``margin`` of the highest one's."""
        logs = self.top.logs(rows)
        near = largest(logs, min(count, logs.shape[1]))
        logs = np.take_along_axis(logs, near, 1)
        line, slot = np.nonzero(logs >= logs.max(axis=1, keepdims=True) - margin - SLACK)
        part, base = near[line, slot], logs[line, slot]
        at, leaf, log = [line[:0]], [line[:0]], [base[:0]]
        order = np.argsort(part, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
            router = self.below.get(int(part[group[0]]))
            inner = router.logs(rows[line[group]]) if router is not None else np.zeros((len(group), 1), "f4")
            few = largest(inner, min(count, inner.shape[1]))
            log.append((np.take_along_axis(inner, few, 1) + base[group, None]).ravel())
            at.append(np.repeat(line[group], few.shape[1]))
            leaf.append((part[group[0]].astype("i8") * WIDTH + few).ravel())
        at, leaf, log = (np.concatenate(x) for x in (at, leaf, log))
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, at, log)
        good = log >= best[at] - margin
        at, leaf, log = at[good], leaf[good], log[good]
        order = np.lexsort((leaf, -log, at))
        at, leaf = at[order], leaf[order]
        head = np.arange(len(at)) - np.searchsorted(at, at) < count
        return at[head], leaf[head]

    def shares(self) -> dict[int, float]:
        """Expected share of the table of every leaf."""
        out = {}
        for part, share in enumerate(self.top.share):
            router = self.below.get(part)
            for inner, own in enumerate(router.share if router is not None else [1.0]):
                out[part * WIDTH + inner] = float(share * own)
        return out


def neighbour_graph(rows: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of every row, by exact comparison in blocks."""
    out = np.empty((len(rows), k), "i4")
    step = max(32, CELLS // max(1, len(rows)))
    for i in range(0, len(rows), step):
        sims = rows[i : i + step] @ rows.T
        sims[np.arange(len(sims)), np.arange(i, i + len(sims))] = -2
        out[i : i + step] = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return out


def best_column(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The column with the largest product of every row, without the whole product in memory."""
    step = max(32, CELLS // max(1, columns.shape[1]))
    return np.concatenate([(rows[i : i + step] @ columns).argmax(axis=1) for i in range(0, len(rows), step)])


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.25) -> np.ndarray:
    """Cuts the graph into parts of at most ``slack`` times the mean size with few cut edges.

    Starts from spherical k-means and then moves nodes to the part that holds
    most of their neighbours, best gains first, as far as the sizes allow.
    """
    n, rng = len(rows), np.random.default_rng(5)
    centre = rows[rng.choice(n, parts, replace=False)].copy()
    for _ in range(8):
        label = best_column(rows, centre.T)
        total = np.zeros_like(centre)
        np.add.at(total, label, rows)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-9), centre)
    cap = int(np.ceil(slack * n / parts))
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1), np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])], 1)])
    for _ in range(rounds):
        key, votes = np.unique(both[:, 0].astype("i8") * parts + label[both[:, 1]], return_counts=True)
        node, part = key // parts, key % parts
        own = np.zeros(n, "i8")
        here = part == label[node]
        own[node[here]] = votes[here]
        size = np.bincount(label, minlength=parts)
        gain = votes - own[node] + np.where(size[label[node]] > cap, 1_000, 0)  # overfull parts give nodes away at a loss
        gain = np.where(here | (size[part] >= cap), -1, gain)
        order = np.lexsort((node, -gain))
        order = order[gain[order] > 0]
        _, first = np.unique(node[order], return_index=True)
        order = order[np.sort(first)]
        moved = 0
        room, spare = cap - size, np.where(size > cap, size - cap, size)
        for i in order:
            a, b = label[node[i]], part[i]
            if room[b] > 0 and (gain[i] < 500 or spare[a] > 0):
                label[node[i]] = b
                room[b] -= 1
                room[a] += 1
                spare[a] -= 1
                moved += 1
        if moved < n // 500:
            break
    return label


def fit_parts(rows: np.ndarray, parts: int, epochs: int = 10) -> Router:
    """Parts and their classifier, fitted to sample rows of unit length (single precision)."""
    n, dims = rows.shape
    if parts <= 1 or n <= NEIGHBOURS + 1:
        return Router(np.zeros((dims, 1), "f4"), np.zeros(1, "f4"), np.ones(1))
    graph = neighbour_graph(rows, NEIGHBOURS)
    label = balanced_parts(rows, graph, parts)
    centre = np.zeros((parts, dims), "f4")
    np.add.at(centre, label, rows)
    centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    weights, bias = (12 * centre.T).astype("f4"), np.zeros(parts, "f4")
    m, v = [np.zeros_like(weights), np.zeros_like(bias)], [np.zeros_like(weights), np.zeros_like(bias)]
    rng, step = np.random.default_rng(11), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, 512):
            at = order[i : i + 512]
            x = rows[at]
            z = x @ weights + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            line = np.arange(len(at))
            z[line, label[at]] -= 0.5  # half of the target is the row's own part, half the parts of its neighbours
            np.subtract.at(z, (np.repeat(line, graph.shape[1]), label[graph[at]].ravel()), 0.5 / graph.shape[1])
            z /= len(at)
            step += 1
            for j, (w, g) in enumerate(((weights, x.T @ z), (bias, z.sum(axis=0)))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.99 * v[j] + 0.01 * g * g
                w -= 0.05 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.99**step)) + 1e-8)
    share = np.bincount(best_column(np.hstack([rows, np.ones((n, 1), "f4")]), np.vstack([weights, bias])), minlength=parts) / n
    return Router(weights.astype("f4"), bias.astype("f4"), share)


def sampled(packed: DataFrame, share: float, seed: int) -> DataFrame:
    """A share of the vectors, decided by a hash of the vector."""
    return packed.where(F.pmod(F.xxhash64("q", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))


def fit_top(packed: DataFrame, dims: int, total: int, parts: int) -> Router:
    """Trains on a sample of distinct vectors, about ``SAMPLE_PER_PART`` a part."""
    size = max(MIN_SAMPLE, SAMPLE_PER_PART * parts)
    rows = sorted({bytes(r) for r in sampled(packed.select("q"), 1.1 * size / max(total, 1), 3).toArrow().column(0).to_pylist()})
    return fit_parts(unpack(pa.array(rows, pa.binary()), dims), min(parts, len(rows) // 16))


def fit_tree(packed: DataFrame, dims: int, total: int) -> Tree:
    """Classifiers for ``total`` distinct vectors; both levels are about the root of the number of parts wide.

    Samples hold about ``SAMPLE_PER_PART`` vectors a part, and are thinned further where the first
    level expects a part far above the mean, so no task and no driver gets more than a
    multiple of the root of the table.
    """
    parts = max(1, round(total / ROWS_PER_PART))
    if parts <= FLAT_PARTS:
        return Tree(fit_top(packed, dims, total, parts), {})
    top = fit_top(packed, dims, total, math.ceil(math.sqrt(parts)))
    rate = SAMPLE_PER_PART / ROWS_PER_PART
    # of a part that is much larger than the others a smaller share is drawn; its number of parts grows all the same
    thin = np.minimum(1.0, 8 * max(MIN_SAMPLE, total * rate / top.parts) / np.maximum(1, top.share * total * rate))
    shared = packed.sparkSession.sparkContext.broadcast((Tree(top, {}), thin))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keep = shared.value
        for batch in batches:
            if batch.num_rows:
                part = tree.home(unpack(batch.column(0), dims)) // WIDTH
                drawn = pc.divide(batch.column(1), 1 << 30).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(drawn < keep[part])
                yield pa.RecordBatch.from_arrays([pa.array(part[at].astype("i4")), batch.column(0).take(pa.array(at))], ["part", "q"])

    def fit(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = unpack(pa.array(sorted(table.column("q").to_pylist()), pa.binary()), dims)
        router = fit_parts(rows, min(round(len(rows) / thin[part] / (rate * ROWS_PER_PART)), len(rows) // 16))
        return pa.table({"part": pa.array([part], pa.int32()), "weights": [router.weights.tobytes()], "bias": [router.bias.tobytes()], "share": [router.share.astype("f8").tobytes()]})

    drawn = F.pmod(F.xxhash64("q", F.lit(7)), F.lit(1 << 30)).cast("double")
    some = sampled(packed.select("q"), rate, 5).select("q", drawn.alias("drawn")).mapInArrow(route, "part int, q binary")
    models = some.repartition(top.parts, "part").groupBy("part").applyInArrow(fit, "part int, weights binary, bias binary, share binary").toArrow()
    below = {}
    for part, weights, bias, share in zip(*(models.column(i).to_pylist() for i in range(4))):
        below[part] = Router(np.frombuffer(weights, "f4").reshape(dims, -1), np.frombuffer(bias, "f4"), np.frombuffer(share, "f8"))
    return Tree(top, below)


# ---- distinct vectors and their blocks ---------------------------------------------------------


def distinct_vectors(packed: DataFrame, query: Column) -> DataFrame:
    """One row per distinct direction, with a number of its own (``node``).

    Copies are merged here, on the map side first, so a vector that a third of
    all rows share is stored and compared once. ``query``: whether a row asks.
    ``copies`` is the number of its rows.
    """
    one = packed.groupBy("q").agg(F.max(query.cast("int")).alias("asks"), F.count("*").alias("copies"))
    return materialize(one.select(F.monotonically_increasing_id().alias("node"), "q", F.xxhash64("q").alias("h1"), F.hash("q").alias("h2"), "asks", "copies"), "vectors")


def members(packed: DataFrame, nodes: DataFrame, *more: str) -> DataFrame:
    """``id`` and ``node`` (and ``more`` columns of nodes) of every row, one per pair. Joins on 96 bits of hash instead of the vector;
    a vector that very many rows share is no hot key (see ``skew_join``)."""
    keys = packed.select("id", F.xxhash64("q").alias("h1"), F.hash("q").alias("h2")).distinct()
    return skew_join(keys, nodes.select("node", "h1", "h2", "copies", *more), ["h1", "h2"], "copies").select("id", "node", *more)


def compared(nodes: DataFrame, dims: int, probes: int | None, margin: float, work: Work, schema: str) -> DataFrame:
    """Results of ``work(query nodes, query rows, stored nodes, stored rows)`` over all parts.

    ``nodes`` is a table with ``node``, ``q`` and ``asks``. A query goes to at most ``probes``
    leaves (default: 1.5 times the root of their number), those within ``margin`` of its most
    probable one: deep inside a part that is few, near the border of several it is more.
    """
    total = nodes.count()
    rows = nodes.select("node", "q", "asks", F.lit(True).alias("kept"))
    if total <= SHARD_ROWS:
        return _in_blocks(_sent(rows, fit_tree(nodes, dims, total), dims, probes, margin, total), dims, work, schema)
    top = fit_top(nodes, dims, total, 2 * -(-total // SHARD_ROWS))
    shared = nodes.sparkSession.sparkContext.broadcast(Tree(top, {}))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = unpack(batch.column(1), dims)
                home = shared.value.home(vectors)
                at, shard = shared.value.probable(vectors, probes or top.parts, margin)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(at)) for i in range(3)), pa.array(home[at] == shard), pa.array((shard // WIDTH).astype("i4"))], ["node", "q", "asks", "kept", "shard"])

    routed = rows.drop("kept").mapInArrow(route, "node long, q binary, asks int, kept boolean, shard int").where("kept or asks > 0")
    routed = materialize(routed, "shards", by=["shard"])
    sizes = {r["shard"]: r["n"] for r in routed.where("kept").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    found = []
    for shard, n in sorted(sizes.items()):  # each is written, so that neither plans nor broadcasts pile up
        part = routed.where(F.col("shard") == shard).drop("shard")
        found.append(materialize(_in_blocks(_sent(part, fit_tree(part.where("kept"), dims, n), dims, probes, margin, n), dims, work, schema), "shard"))
    return reduce(DataFrame.unionByName, found)


def default_probes(leaves: int) -> int:
    """1.5 times the root of the number of leaves, but at least 12 % of them: vectors without any clusters need a share."""
    return min(leaves, max(math.ceil(1.5 * math.sqrt(leaves)), math.ceil(0.12 * leaves)))


def _sent(rows: DataFrame, tree: Tree, dims: int, probes: int | None, margin: float, total: int) -> DataFrame:
    """A row for every (block, vector) that is to be compared there.

    A part of more than ``BLOCK_ROWS`` expected vectors is a grid of blocks:
    stored vectors are repeated along one side, queries along the other, so no
    task holds more than a block of either whatever the skew.
    """
    spark = rows.sparkSession
    shares = tree.shares()
    probes = probes or default_probes(len(shares))
    grids = {leaf: math.ceil(share * total / BLOCK_ROWS) for leaf, share in shares.items() if share * total > BLOCK_ROWS}
    large = np.array(sorted(grids), "i8")
    shared = spark.sparkContext.broadcast((tree, large, np.array([grids[leaf] for leaf in large.tolist()], "i8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, big, sides = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = unpack(batch.column(1), dims)
            node = batch.column(0).to_numpy()
            line = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False) > 0)
            kept = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
            near, leaf = model.probable(vectors[line], probes, margin)
            home = np.full(len(vectors), -1, "i8")
            home[kept] = model.home(vectors[kept])
            at, part = np.concatenate([kept, line[near]]), np.concatenate([home[kept], leaf])
            role = np.where(np.arange(len(at)) < len(kept), STORED, ASKS)
            times = np.ones(len(at), "i8")
            if len(big):
                place = np.minimum(np.searchsorted(big, part), len(big) - 1)
                times = np.where(big[place] == part, sides[place], 1)
            # a vector that asks in the one block where it is stored goes there once
            twice = (role == ASKS) & (part == home[at]) & (times == 1)
            both = np.zeros(len(vectors), bool)
            both[at[twice]] = True
            role[: len(kept)] = np.where(both[kept], STORED + ASKS, STORED)
            at, part, role, times = at[~twice], part[~twice], role[~twice], times[~twice]
            spot = np.repeat(np.arange(len(at)), times)
            walk = np.arange(len(spot)) - np.repeat(np.cumsum(times) - times, times)
            own = (node[at] * 0x9E3779B1 >> 7) % times
            row, kind = at[spot], role[spot]
            block = np.where(kind & STORED, own[spot] * times[spot] + walk, walk * times[spot] + own[spot])
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[spot]), pa.array(block.astype("i4")), pa.array(kind.astype("i1")), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                ["part", "block", "role", "node", "q"],
            )

    sent = rows.select("node", "q", "asks", "kept").mapInArrow(run, "part long, block int, role byte, node long, q binary")
    # about 200,000 rows a task at most, so that a task stays small whatever the session's setting
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total * (min(probes, 12) + 1) // 200_000))
    return sent.repartition(int(tasks), "part", "block")


def _in_blocks(sent: DataFrame, dims: int, work: Work, schema: str) -> DataFrame:
    """Applies ``work`` to every block."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy(zero_copy_only=False)
        stored, asks = role & STORED > 0, role & ASKS > 0
        node, rows = table.column("node").to_numpy(), unpack(table.column("q"), dims)
        return work(node[asks], rows[asks], node[stored], rows[stored])

    return sent.groupBy("part", "block").applyInArrow(run, schema)
