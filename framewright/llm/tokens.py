"""Problem 7: byte-level BPE encoding of a text column, and decoding."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.storage import spread

#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct pieces whose ids a worker remembers before it starts afresh.
CACHE_PIECES = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (``base64 id`` a line); an id is also the rank of its merge."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merges the pair of lowest rank, leftmost first, until none is left.

    The symbols are a doubly linked list and the possible merges a priority
    queue; an entry whose symbols were merged meanwhile is skipped when it
    comes up. Time grows as n log n, so a piece may be as long as a text.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the symbol that starts at i ends; 0 once it is merged away
    before = list(range(-1, n - 1))
    queue = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        rank, left, stop = heapq.heappop(queue)
        middle = end[left]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[left], end[middle] = stop, 0
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(piece[left : end[stop]])) is not None:
                heapq.heappush(queue, (rank, left, end[stop]))
        if (prior := before[left]) >= 0 and (rank := ranks.get(piece[prior:stop])) is not None:
            heapq.heappush(queue, (rank, prior, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes texts with one vocabulary, remembering the pieces it has seen."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.split, self.seen = ranks, regex.compile(PATTERN).findall, {}

    def add(self, text: str, out: array) -> None:
        seen, extend = self.seen, out.extend
        for piece in self.split(text):
            ids = seen.get(piece)
            if ids is None:
                if len(seen) >= CACHE_PIECES:
                    seen.clear()
                ids = array("i", merge_piece(piece.encode(), self.ranks))
                if len(piece) <= 64:
                    seen[piece] = ids
            extend(ids)

    def encode(self, text: str) -> list[int]:
        out = array("i")
        self.add(text, out)
        return list(out)


def encode_texts(table: DataFrame, key: str, text: str, rank_file: str) -> DataFrame:
    """``key`` and ``ids`` of every row; no special tokens, whose strings are ordinary text.

    A null and an empty text have no tokens: their ``ids`` is an empty list, never
    null. Every row, repeated ones too, gives one row; a null key stays
    null. Blank or very long texts are encoded whole. Other columns are ignored.
    The rank file is read on the driver and sent once to each executor; a
    vocabulary has a fixed size (about 1 MB), whatever the corpus.
    """
    shared = table.sparkSession.sparkContext.broadcast(load_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            offsets, flat = array("i", [0]), array("i")
            for value in batch.column(1):
                if s := value.as_py():
                    encoder.add(s, flat)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["key", "ids"])

    kind = table.schema[key].dataType.simpleString()
    return spread(table.select(F.col(key).alias("key"), F.col(text).alias("text"))).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_ids(ids: list[int], names: list[bytes]) -> str:
    """Text of ids, by concatenating the bytes of the vocabulary."""
    return b"".join([names[i] for i in ids]).decode("utf-8", "replace")


def decode_texts(table: DataFrame, key: str, ids: str, rank_file: str) -> DataFrame:
    """``key`` and ``text`` of every row of encoded texts; null ids give a null text."""
    ranks = load_ranks(rank_file)
    names = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token
    shared = table.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if v is None else decode_ids(v, shared.value) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = table.schema[key].dataType.simpleString()
    return table.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
