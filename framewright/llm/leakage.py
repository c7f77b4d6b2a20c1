"""Problem 8: passages of evaluation texts inside a corpus, by a prefix-filtered set join.

An item is seen as its windows of 13 consecutive words, a window as the set of
its five-word shingles. A document can only contain a window if it contains all
its shingles, so it is enough to join on one, the necessary prefix: the one that
is rarest in the corpus. Where a document has it, its place must leave room for the
whole window (positional and length bounds), and the words there are compared.

Both sides of the join are tables; the corpus is read twice however many items there are.
A shingle is joined by a 64-bit hash. A Bloom filter of the items' hashes, of bounded
size, keeps all but a few of the corpus' shingles from being shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import skew_join
from framewright.storage import materialize, spread

SHINGLE_WORDS = 5
#: Bits of a Bloom filter per shingle, and of the whole filter at least and at most (64 MB); a full filter only lets more through.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
#: Bits of a filter that one row holds while it is put together.
CHUNK_BITS = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], "u8")

_words = re.compile(r"[^\W_]+").findall


def words_of(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    if not text:
        return []
    return _words(text.lower()) if text.isascii() else [w.lower() for w in _words(text)]


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[str], hashes: dict[str, int]) -> np.ndarray:
    """64-bit hash of every run of ``SHINGLE_WORDS`` words; ``hashes`` keeps those of the words."""
    n = len(words) - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, "u8")
    each = np.fromiter((hashes[w] for w in words), "u8", len(words))
    out = np.zeros(n, "u8")
    for k in range(SHINGLE_WORDS):
        out += (each[k : n + k] ^ (each[k : n + k] >> np.uint64(29))) * _FACTORS[k]
    return out ^ (out >> np.uint64(32))


def batch_hashes(texts: list[list[str]], hashes: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of every shingle of several texts, in one go."""
    sizes = np.array([len(t) for t in texts], "i8")
    every = shingle_hashes([w for t in texts for w in t], hashes)
    start = np.cumsum(sizes) - sizes
    line = np.repeat(np.arange(len(texts)), np.maximum(0, sizes - SHINGLE_WORDS + 1))
    shingles = np.maximum(0, sizes - SHINGLE_WORDS + 1)
    place = np.arange(len(line)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    return line, place, every[start[line] + place] if len(line) else every[:0]


def _spots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of a filter for every hash."""
    mask = np.uint64(bits - 1)
    return [hashes & mask, (hashes >> np.uint64(17)) * np.uint64(0x9E3779B1) & mask, (hashes >> np.uint64(31)) & mask]


def bloom_filter(table: DataFrame) -> np.ndarray:
    """Filter of the long column ``hash``: put together on the executors, at most ``MOST_BITS`` bits come to the driver."""
    n = table.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(BITS_EACH * max(n, 1) - 1).bit_length()))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            spots = np.concatenate(_spots(batch.column(0).to_numpy().view("u8"), bits)).astype("i8")
            for chunk in np.unique(spots // CHUNK_BITS).tolist():
                flags = mine.setdefault(chunk, np.zeros(min(bits, CHUNK_BITS), bool))
                flags[spots[spots // CHUNK_BITS == chunk] % CHUNK_BITS] = True
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(mine), pa.int32()), "bits": pa.array([np.packbits(f).tobytes() for f in mine.values()], pa.binary())})

    def unite(part: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(b, "u1") for b in part.column("bits").to_pylist()])
        return pa.table({"chunk": part.column("chunk").slice(0, 1), "bits": pa.array([both.tobytes()], pa.binary())})

    out = np.zeros((max(1, bits // CHUNK_BITS), min(bits, CHUNK_BITS) // 8), "u1")
    for row in table.mapInArrow(set_bits, "chunk int, bits binary").groupBy("chunk").applyInArrow(unite, "chunk int, bits binary").toLocalIterator():
        out[row["chunk"]] = np.frombuffer(row["bits"], "u1")
    return out.ravel()


def passes(flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the filter's."""
    ok = np.ones(len(hashes), bool)
    for spot in _spots(hashes, len(flags) * 8):
        ok &= (flags[spot >> np.uint64(3)] >> (np.uint64(7) - (spot & np.uint64(7))).astype("u1")) & 1 == 1
    return ok


def item_windows(items: DataFrame, run_words: int) -> DataFrame:
    """Distinct ``window`` (its words with blanks between) and ``item_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {(" ".join(w[i : i + run_words]), key) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in [words_of(text)] for i in range(len(w) - run_words + 1)}
            yield pa.RecordBatch.from_pydict({"window": pa.array([w for w, _ in out], pa.string()), "item_id": pa.array([k for _, k in out], pa.int64())})

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    return materialize(spread(rows).mapInArrow(run, "window string, item_id long").distinct(), "windows")


def window_shingles(windows: DataFrame) -> DataFrame:
    """``window``, ``place`` and ``hash`` of every shingle of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [shingle_hashes(t.split(" "), hashes) for t in texts]
            sizes = [len(f) for f in found]
            yield pa.RecordBatch.from_pydict({
                "window": pa.array([t for t, n in zip(texts, sizes) for _ in range(n)], pa.string()), "place": pa.array([i for n in sizes for i in range(n)], pa.int32()),
                "hash": pa.array(np.concatenate([*found, np.zeros(0, "u8")]).view("i8")),
            })

    return windows.select("window").distinct().mapInArrow(run, "window string, place int, hash long")


def document_frequency(documents: DataFrame, flags: np.ndarray) -> DataFrame:
    """``hash`` and ``documents``: in how many documents each shingle that passes the filter occurs, over the whole corpus."""
    shared = documents.sparkSession.sparkContext.broadcast(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _WordHashes(), Counter()
        for batch in batches:
            line, _, every = batch_hashes([words_of(t) for t in batch.column(0).to_pylist()], hashes)
            good = passes(shared.value, every)
            counts.update(h for _, h in set(zip(line[good].tolist(), every[good].tolist())))
        yield pa.RecordBatch.from_pydict({"hash": pa.array(np.fromiter(counts, "u8", len(counts)).view("i8")), "n": pa.array(list(counts.values()), pa.int64())})

    return spread(documents.select("text").where("text is not null")).mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("documents"))


def spots_in_documents(documents: DataFrame, flags: np.ndarray, run_words: int) -> DataFrame:
    """``doc_id``, ``hash``, ``words`` and ``before`` of every shingle that passes the filter.

    ``words`` are those that a window with this shingle could reach, of which ``before``
    stand before the shingle. Spots without room for a window are left out.
    """
    shared = documents.sparkSession.sparkContext.broadcast(flags)
    reach = run_words - SHINGLE_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [words_of(t) for t in batch.column(1).to_pylist()]
            line, place, every = batch_hashes(texts, hashes)
            good = passes(shared.value, every)
            docs, found, spans, before = [], every[good], [], []
            for k, i in zip(line[good].tolist(), place[good].tolist()):
                start = max(0, i - reach)
                docs.append(keys[k])
                spans.append(texts[k][start : i + SHINGLE_WORDS + reach])
                before.append(i - start)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "hash": pa.array(found.view("i8")), "words": pa.array(spans, pa.list_(pa.string())), "before": pa.array(before, pa.int32())})

    return spread(documents.where("doc_id is not null and text is not null")).mapInArrow(run, "doc_id long, hash long, words array<string>, before int")


def leaked_items(documents: DataFrame, items: DataFrame, run_words: int = 13) -> DataFrame:
    """Document and item that share a run of at least ``run_words`` consecutive words.

    ``documents`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    Rows with a null id or text have no pairs, nor have texts of fewer than
    ``run_words`` words (``run_words`` is at least five); repeated rows count once; if either table is empty the
    result is. Texts are read whole. The rarest shingle of a window decides where it is
    looked for; a window with a shingle that no document has is dropped. A passage that very many documents
    hold is no hot key: the windows of such shingles are broadcast (see ``skew_join``).
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    holders = item_windows(items, run_words)
    shingles = materialize(window_shingles(holders), "shingles")
    frequency = document_frequency(docs, bloom_filter(shingles.select("hash").distinct()))
    known = shingles.join(frequency, "hash", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("documents", F.lit(0)).alias("documents"), "hash", "place")).alias("first"))
    prefixes = materialize(known.select("window", "first.*").where("documents > 0"), "prefixes")
    spots = materialize(spots_in_documents(docs, bloom_filter(prefixes.select("hash").distinct()), run_words), "spots")
    near = skew_join(spots, prefixes.select("hash", "window", "place", "documents"), ["hash"], "documents")
    whole = near.where((F.col("before") >= F.col("place")) & (F.array_join(F.slice("words", F.col("before") - F.col("place") + 1, run_words), " ") == F.col("window")))
    leaks = materialize(whole.select("doc_id", "window").distinct(), "leaks")
    return skew_join(leaks, holders.join(prefixes.select("window", "documents"), "window"), ["window"], "documents").select("doc_id", "item_id").distinct()


def leak_report(leaks: DataFrame, items: DataFrame) -> DataFrame:
    """For every item the number of documents that give it away, 0 included."""
    count = leaks.groupBy("item_id").agg(F.count("*").alias("documents"))
    return items.select(F.col("item_id").cast("long").alias("item_id")).where("item_id is not null").distinct().join(count, "item_id", "left").select("item_id", F.coalesce("documents", F.lit(0)).alias("documents"))
