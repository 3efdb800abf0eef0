"""Vector best-fit packing of tokenised documents into sequences.

Every bin has three residual capacities: tokens, documents and attention cost (the
sum of squared lengths). Items go longest first to the bin that fits best among all
bins with room in every capacity. Which items of a length go where does not matter,
so the packing works on counts by length: bins with equal contents are one class with
a number of bins. Lengths are bounded by the size of a sequence, and so is what the
driver holds, whatever the number of documents. The tasks then give the k-th piece of
each length its place in the k-th such slot.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, text_of
from .tokens import END_ID, encode_all, larger, pieces_of, tokenizer_path

#: Pieces of one length that one task ranks.
RANKED_TOGETHER = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Bins:
    """``many`` bins of the same contents: the lengths in them, and what is left of each capacity."""

    lengths: tuple[int, ...]
    many: int
    left: np.ndarray


def best_fit(counts: dict[int, int], capacity: tuple[float, float, float], score: str = "norm") -> list[Bins]:
    """Pack ``counts`` items of each length, longest first.

    ``score="norm"`` takes the bin with the least residual norm after the item,
    ``"dot"`` the one with the largest dot product of demand and residual; both in
    shares of the capacities, weighted by how scarce each is over all items. Ties
    go to the fuller bin, then to the older. An item that no empty bin can take is an error.
    """
    if score not in ("norm", "dot"):
        raise ValueError("score is norm or dot")
    full = np.array(capacity, float)
    demand = lambda n: np.array([n, 1, n * n], float)
    total = sum((c * demand(n) for n, c in counts.items()), np.zeros(3)) / full
    weight = total / total.max() if total.max() > 0 else np.ones(3)
    bins: list[Bins] = []
    left = np.zeros((0, 3))
    for n in sorted((n for n, c in counts.items() if c), reverse=True):
        need, todo = demand(n), counts[n]
        if (need > full).any():
            raise ValueError(f"a piece of {n} tokens fits no empty sequence")
        while todo:
            fits = np.flatnonzero((left >= need).all(axis=1))
            if not len(fits):
                # New bins: each takes as many of this length as it holds, which is where best fit would put them.
                each = int((full / need).min())
                for k, many in ((each, todo // each), (todo % each, 1)):
                    if k and many:
                        bins.append(Bins((n,) * k, many, full - k * need))
                        left = np.vstack([left, bins[-1].left])
                break
            rest = (left[fits] - need) / full * weight
            value = (rest**2).sum(axis=1) if score == "norm" else -((left[fits] / full * weight) @ (need / full * weight))
            i = int(fits[np.lexsort((fits, left[fits, 0], value))[0]])
            b = bins[i]
            # All bins of the class take as many items as they hold, since the class stays the best fit; at most the items left.
            each = min(int((b.left / need).min()), max(1, todo // b.many))
            used = min(b.many, todo // each)
            placed = Bins(b.lengths + (n,) * each, used, b.left - each * need)
            todo -= used * each
            if used == b.many:
                bins[i], left[i] = placed, placed.left
            else:
                b.many -= used
                bins.append(placed)
                left = np.vstack([left, placed.left])
    return bins


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than ``size``."""
    first = length % size
    starts = ([0] if first else []) + list(range(first, length, size))
    return [(s, (first if s == 0 and first else size)) for s in starts]


def pieces(docs: DataFrame, size: int = 1024, path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """Pieces of at most ``size`` tokens of every document; null texts are empty and hold the end id."""
    ship(docs.sparkSession)
    path = path or tokenizer_path()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def split(batches):
        known = pieces_of(path)
        for batch in larger(batches):
            rows = []
            flat, bounds = encode_all(batch.column(1), known, end_id)
            raw = memoryview(flat.astype("<u4").tobytes())
            for doc_id, begin, end in zip(batch.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                for k, (start, n) in enumerate(cut(end - begin, size)):
                    at = 4 * (begin + start)
                    rows.append((doc_id, k, start, n, zlib.crc32(raw[at : at + 4 * n])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(split, PIECES)


def pack(
    docs: DataFrame,
    size: int = 1024,
    max_documents: int | None = None,
    max_attention: float | None = None,
    score: str = "norm",
    path: str | None = None,
    end_id: int | None = END_ID,
) -> DataFrame:
    """Sequences of at most ``size`` tokens, ``max_documents`` pieces and ``max_attention`` summed squares.

    None leaves a capacity as wide as it can ever be used. One row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset. Rows that repeat are
    packed as often as they occur. An empty table gives no rows.
    """
    spark = docs.sparkSession
    capacity = (size, max_documents or size, max_attention or float(size) ** 2)
    found = stored(pieces(docs, size, path, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    packed = best_fit(counts, capacity, score)

    # Slots of each length: rank from, first sequence, offset in the sequence.
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for b in packed:
        offset = 0
        for n in b.lengths:
            slots.setdefault(n, []).append((taken.get(n, 0), sequence, offset))
            taken[n] = taken.get(n, 0) + b.many
            offset += n
        sequence += b.many
    places = {n: tuple(np.array(c, np.int64) for c in zip(*s)) for n, s in slots.items()}

    # The rank of a piece in its length: counts of buckets before its own, and its rank in the bucket.
    buckets = max(1, -(-sum(counts.values()) // RANKED_TOGETHER))
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sums = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(order) - 1).join(before, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence_id, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                first, sequences, offsets = places[n]
                slot = np.searchsorted(first, rank[at], "right") - 1
                sequence_id[at] = sequences[slot] + rank[at] - first[slot]
                offset[at] = offsets[slot]
            columns = [*batch.columns[:5], pa.array(sequence_id), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
