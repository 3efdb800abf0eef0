"""What the operators of this folder share: shipping, shared files and word arrays."""

from __future__ import annotations

import importlib
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: Rows per Arrow batch: with very long texts, a batch still fits a worker.
BATCH_ROWS = 500
#: Bytes of text that one numpy pass covers: its arrays stay in the processor's cache.
PASS_BYTES = 1 << 18


def ship(spark: SparkSession) -> None:
    """Send this folder's functions by value, so that executors need no copy of it, and keep Arrow batches small."""
    register_pickle_by_value(importlib.import_module(__package__))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def kept(name: str, make, version=None):
    """What this worker process keeps under a name for later tasks, made on first use and anew for another version."""
    home = sys.modules.setdefault("scorelake_kept", types.ModuleType("scorelake_kept")).__dict__
    if name not in home or home[name][0] != version:
        home[name] = (version, make())
    return home[name][1]


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither repeat its work nor lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame) -> Column:
    """The text, empty for null."""
    return F.coalesce(df["text"], F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    longest = "_" * (max(map(len, taken), default=0) + 1)
    return [longest + n if n.lower() in taken else n for n in names]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and where each text begins, with the end of the last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if len(offsets) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def passes(offsets: np.ndarray, size: int = PASS_BYTES):
    """Ranges of texts of about ``size`` bytes, one text at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def is_space() -> np.ndarray:
    """By byte: space, tab, line feed, vertical tab, form feed, carriage return."""
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


SPACE = is_space()
BASE = np.uint64(0x9E3779B97F4A7C15)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Sums of byte * base ** position: the hash of any slice in one step."""

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n)[:n], out=self.sums[1:])
        self.back = powers(inverse(base), n + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the first word of each text with the number of words at the end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = ~solid[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = ~solid[1:]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)
