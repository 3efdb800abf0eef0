"""Benchmark decontamination by SimHash of item-sized windows.

For an item of n words every window of n words of a document is a candidate. Windows
and items get a SimHash of their five-word shingles, weighted by how often each
occurs. The fingerprint is cut into radius + 1 blocks: two that differ in at most
radius bits agree in a block, so the block tables find all of them. Matches within the
radius are verified by the exact weighted similarity of the shingles (summed
minima by summed maxima of their counts).

A window that reaches the similarity holds that share of an item's shingles at
least, so only windows with as many shingles of items of their size are hashed: a
lossless filter that spares almost all text.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, buffers, kept, mix, passes, ship, text_of, words_of
from .near_copies import LOWER

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS = 64, 24
#: Bytes of benchmark text that the tasks hold at once; a larger benchmark is searched part by part.
PART_BYTES = 32 << 20
MATCH = "array<struct<item:int,start:int,n_words:int,similarity:double>>"

#: Words are runs of ASCII letters and digits and of all other characters outside ASCII.
BREAK = np.ones(256, bool)
BREAK[48:58] = BREAK[65:91] = BREAK[97:123] = False
BREAK[128:] = False
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each."""
    starts, ends, bounds = words_of(data, offsets, BREAK)
    return (Prefix(LOWER[data]).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)), bounds


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        out = out * FACTOR + words[i : i + n]
    return mix(out)


def signs(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


def blocks(radius: int = RADIUS) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 blocks of the fingerprint."""
    cuts = np.linspace(0, BITS, radius + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Summed minima by summed maxima of the counts."""
    x, y = Counter(a.tolist()), Counter(b.tolist())
    return sum((x & y).values()) / sum((x | y).values())


class Index:
    """Items by their number of words: shingles, fingerprints and block tables."""

    def __init__(self, texts: list[str], least: float = SIMILARITY, radius: int = RADIUS):
        data, offsets = buffers(pa.array(texts, pa.large_string()))
        words, bounds = word_hashes(data, offsets)
        self.least, self.radius, self.blocks = least, radius, blocks(radius)
        self.sizes: dict[int, list[int]] = {}
        self.items: dict[int, np.ndarray] = {}
        self.prints: dict[int, int] = {}
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        known: dict[int, list[np.ndarray]] = {}
        for i in range(len(texts)):
            own = words[bounds[i] : bounds[i + 1]]
            if not len(own):
                continue
            width = min(SHINGLE, len(own))
            self.items[i] = shingles(own, width)
            self.prints[i] = int(simhash(signs(self.items[i]).sum(axis=0)[None])[0])
            self.sizes.setdefault(len(own), []).append(i)
            known.setdefault(width, []).append(self.items[i])
        self.known = {w: np.unique(np.concatenate(s)) for w, s in known.items()}
        # For each shingle, the sizes of the items that hold it.
        self.found_in: dict[int, dict[int, list[int]]] = {w: {} for w in known}
        for size, items in sorted(self.sizes.items()):
            for key in np.unique(np.concatenate([self.items[i] for i in items])).tolist():
                self.found_in[min(SHINGLE, size)].setdefault(key, []).append(size)
        for n, items in self.sizes.items():
            self.tables[n] = [{} for _ in self.blocks]
            for i in items:
                for table, (shift, width) in zip(self.tables[n], self.blocks):
                    table.setdefault(self.prints[i] >> shift & (1 << width) - 1, []).append(i)

    def windows(self, places: list[int], size: int, width: int, n: int) -> list[int]:
        """Starts of the windows that hold enough of the given places of shingles to reach the similarity."""
        span = min(size, n) - width + 1
        need = max(1, int(np.ceil(self.least * (size - width + 1) - 1e-9)))
        starts: list[int] = []
        for first, last in zip(places, places[need - 1 :]):
            low = max(last - span + 1, starts[-1] + 1 if starts else 0, 0)
            starts.extend(range(low, min(first, n - width + 1 - span) + 1))
        return starts

    def search(self, words: np.ndarray, hits: dict[int, np.ndarray]) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item that a text holds."""
        best: dict[int, tuple[float, int, int]] = {}
        n = len(words)
        for width, at in hits.items():
            mine = shingles(words, width)
            places: dict[int, list[int]] = {}
            for place, key in zip(at.tolist(), mine[at].tolist()):
                for size in self.found_in[width][key]:
                    places.setdefault(size, []).append(place)
            for size, own in places.items():
                span = min(size, n) - width + 1
                starts = self.windows(own, size, width, n) if span > 0 else []
                if not starts:
                    continue
                low, begin = starts[0], np.array(starts) - starts[0]
                sums = np.zeros((starts[-1] + span - low + 1, BITS), np.int32)
                np.cumsum(signs(mine[low : starts[-1] + span]), axis=0, out=sums[1:])
                for w, mark in zip(starts, simhash(sums[begin + span] - sums[begin]).tolist()):
                    seen = set()
                    for table, (shift, bits) in zip(self.tables[size], self.blocks):
                        seen.update(table.get(mark >> shift & (1 << bits) - 1, ()))
                    for i in sorted(seen):
                        if (mark ^ self.prints[i]).bit_count() > self.radius or (i in best and best[i][0] == 1):
                            continue
                        s = similarity(mine[w : w + span], self.items[i])
                        if s >= self.least and (i not in best or s > best[i][0]):
                            best[i] = (s, w, min(size, n))
        return [(i, w, size, s) for i, (s, w, size) in sorted(best.items())]

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        words, bounds = word_hashes(data, offsets)
        flags = {}
        for width, known in self.known.items():
            all_ = shingles(words, width)
            at = np.minimum(np.searchsorted(known, all_), len(known) - 1)
            flags[width] = known[at] == all_
        sums = {w: np.concatenate([[0], np.cumsum(f)]) for w, f in flags.items()}
        out = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            some = {w: np.flatnonzero(flags[w][a : b - w + 1]) for w in flags if b - a >= w and sums[w][b - w + 1] > sums[w][a]}
            out.append(self.search(words[a:b], some) if some else [])
        return out


def matches(text: Column, shared) -> Column:
    """Items of a broadcast `Index` (its class goes along by value) that a text holds. A worker loads an index once."""
    version = uuid.uuid4().hex

    @F.arrow_udf(MATCH)
    def run(texts: pa.Array) -> pa.Array:
        index = kept("contamination", lambda: pickle.loads(shared.value), version)
        data, offsets = buffers(texts)
        rows = []
        for i, j in passes(offsets):
            rows += index.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        names = ("item", "start", "n_words", "similarity")
        kind = pa.list_(pa.struct([(names[0], pa.int32()), (names[1], pa.int32()), (names[2], pa.int32()), (names[3], pa.float64())]))
        return pa.array([[dict(zip(names, m)) for m in r] for r in rows], kind)

    return run(text)


def parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> list[list[tuple[int, str]]]:
    """The items in parts of bounded size, each fetched only when it is used."""
    items = benchmark.select("item_id", text_of(benchmark).alias("text")).where("text != ''")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // part_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.where(part == k) if n > 1 else items for k in range(n)]


def indexes(benchmark: DataFrame, least: float, part_bytes: int):
    """(broadcast index, its items) for each part of the benchmark."""
    context = benchmark.sparkSession.sparkContext
    for part in parts(benchmark, part_bytes):
        # Items of one text are searched once.
        rows = part.groupBy("text").agg(F.sort_array(F.collect_list("item_id")).alias("ids"), F.count("*").alias("n")).collect()
        rows.sort(key=lambda r: r["text"])
        yield context.broadcast(cloudpickle.dumps(Index([r["text"] for r in rows], least))), [r["ids"] for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each document and item that it holds: doc_id, item_id, start (word, from 0), n_words, similarity.

    The best window counts, of equal ones the first. Items and texts without words match
    nothing; items of fewer than five words are one shingle; a text shorter
    than an item is one window. Rows that repeat are reported each; items without an id
    are searched but not reported. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    found = []
    for index, ids in indexes(benchmark, least, part_bytes):
        hits = docs.select("doc_id", F.explode(matches(text_of(docs), index)).alias("m")).select("doc_id", "m.*")
        names = spark.createDataFrame([(k, i) for k, own in enumerate(ids) for i in own], "item int, item_id long")
        found.append(hits.join(names, "item").select("doc_id", "item_id", "start", "n_words", "similarity"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    ship(docs.sparkSession)
    names = docs.columns
    column = "_" * max(map(len, names)) + "_items"
    for index, _ in indexes(benchmark, least, part_bytes):
        held = docs.withColumn(column, F.size(matches(text_of(docs), index)))
        docs = held.where(held[column] == 0).select(*[held[f"`{c}`"] for c in names])
    return docs
