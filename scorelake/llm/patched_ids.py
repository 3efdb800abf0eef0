"""Token ids in patched frame-of-reference files.

A file holds the ids of a run of documents in blocks of 1024 ids. A block stores its
minimum, and of each id the difference to it in as many bits as 90 % of the
differences need; what others need more goes to an exception list of positions and
high bits. The
index at the end of a file gives where each block starts and the ids of each document,
so any document can be read by itself.

    header    8 bytes  magic
    blocks    u32 minimum | u8 width | u16 ids | u16 exceptions | packed low bits | u16 positions | u32 high bits
    index     u64 start of each block, u32 ids of each document, i64 id of each document, u8 whether it is null
    footer    u64 index position | u64 blocks | u64 documents | u64 ids | 8 bytes magic
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .common import ship, text_of
from .tokens import END_ID, encode_all, larger, pieces_of, tokenizer_path

MAGIC = b"PFORIDS1"
BLOCK = 1024
PERCENTILE = 0.9
FOOTER = "<QQQQ8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
HEAD = "<IBHH"
HEAD_BYTES = struct.calcsize(HEAD)
INDEX = "file string, first long, docs long, ids long, lowest long"


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at most 65 535 unsigned 32-bit ids."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    width = int(np.partition(rest, k := int(PERCENTILE * (len(rest) - 1)))[k]).bit_length()
    late = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    shifts = np.arange(width, dtype=np.uint32)
    packed = np.packbits((rest[:, None] >> shifts & np.uint32(1)).astype(np.uint8), bitorder="little").tobytes()
    high = (rest[late] >> np.uint32(width % 32)).astype("<u4")
    return struct.pack(HEAD, low, width, len(ids), len(late)) + packed + late.astype("<u2").tobytes() + high.tobytes()


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, width, n, late = struct.unpack_from(HEAD, data, at)
    at += HEAD_BYTES
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little")[: n * width].reshape(n, width)
    rest = np.packbits(bits.reshape(-1), bitorder="little").view("<u4").copy()
    at += size
    positions = np.frombuffer(data, "<u2", late, at)
    if late:
        rest[positions] |= np.frombuffer(data, "<u4", late, at + 2 * late) << np.uint32(width)
    return rest + np.uint32(low)


class Writer:
    """One file; ids go out as soon as a block is full."""

    def __init__(self, out):
        self.out, self.at, self.rest, self.ids = out, 0, np.zeros(0, np.uint32), 0
        self.starts, self.counts, self.docs = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _blocks(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), BLOCK):
            self.starts.append(self.at)
            self._put(pack_block(ids[at : at + BLOCK]))

    def add(self, docs: list, ids: np.ndarray, bounds: np.ndarray) -> None:
        """The ids of some documents in a row, and where each begins and ends."""
        self.docs += docs
        self.counts += np.diff(bounds).tolist()
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> None:
        self._blocks(self.rest)
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array(self.counts, "<u4").tobytes())
        self._put(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        self._put(np.array([d is None for d in self.docs], np.uint8).tobytes())
        self._put(struct.pack(FOOTER, index, len(self.starts), len(self.docs), self.ids, MAGIC))


def read_file(source, size: int):
    """(document, ids) of each document of a file, block after block."""
    source.seek(size - FOOTER_BYTES)
    index, blocks, docs, ids, magic = struct.unpack(FOOTER, source.read(FOOTER_BYTES))
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    source.seek(index)
    starts = np.frombuffer(source.read(8 * blocks), "<u8").astype(np.int64)
    counts = np.frombuffer(source.read(4 * docs), "<u4").astype(np.int64)
    names = np.frombuffer(source.read(8 * docs), "<i8")
    nulls = np.frombuffer(source.read(docs), np.uint8)
    ends = np.append(starts[1:], index)
    block, flat, at = 0, np.zeros(0, "<u4"), 0
    for name, null, n in zip(names.tolist(), nulls.tolist(), counts.tolist()):
        while len(flat) - at < n:
            # 256 blocks a read: far fewer requests to a remote store.
            last = min(block + 256, blocks)
            source.seek(int(starts[block]))
            data = source.read(int(ends[last - 1] - starts[block]))
            got = [unpack_block(data, int(starts[b] - starts[block])) for b in range(block, last)]
            flat, at, block = np.concatenate([flat[at:], *got]), 0, last
        yield None if null else name, flat[at : at + n]
        at += n


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    if folder.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    # Hadoop's name of the store.
    folder = re.sub("^s3[an]:", "s3:", folder)
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """Write the ids of all texts in ascending doc_id order; return the files in that order with the ids before each.

    Null texts are empty, null ids come first, rows of one id follow each other in
    the order of their texts. Every task sorts one range of ids and writes one file,
    under another name until it is whole, so a task that runs again writes the same
    file. The driver sees a line per file. An empty table gives no file.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or tokenizer_path()

    def write(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, root = store_of(folder)
        pieces, writer, out, lowest = pieces_of(path), None, None, None
        name = f"ids-{context.partitionId():06d}.pfor"
        trial = f"{root}/_{name}.{uuid.uuid4().hex}"
        for batch in larger(batches):
            names = batch.column(0).to_pylist()
            if names and writer is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(trial)
                writer, lowest = Writer(out), names[0]
            if names:
                writer.add(names, *encode_all(batch.column(1), pieces, end_id))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(trial, f"{root}/{name}")
            one = {"file": [name], "first": [context.partitionId()], "docs": [len(writer.docs)], "ids": [writer.ids], "lowest": [lowest]}
            yield pa.RecordBatch.from_pydict(one, pa.schema([("file", pa.string())] + [(c, pa.int64()) for c in ("first", "docs", "ids", "lowest")]))

    rows = docs.select("doc_id", text_of(docs).alias("text"))
    # Ranges by id and a digest: rows that share an id may still go to several tasks.
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text").select("doc_id", "text")
    files = sorted(ordered.mapInArrow(write, INDEX).collect(), key=lambda r: r["first"])
    before, out = 0, []
    for r in files:
        out.append((r["file"], before, r["docs"], r["ids"], r["lowest"]))
        before += r["ids"]
    return spark.createDataFrame(spark.sparkContext.parallelize(out, max(1, len(out))), INDEX)


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """One row per document read from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship(files.sparkSession)
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def read(batches):
        fs, root = store_of(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, start, rows = f"{root}/{row['file']}", row["first"], []
                with fs.open_input_file(name) as source:
                    for doc_id, ids in read_file(source, source.size()):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """Write all ids to new files in the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    return read_ids(write_ids(docs, folder, path, end_id), folder)
