"""Keys of a block of documents looked up in a table of all keys.

A block is a batch of documents with the list of its different keys. Only these lists
are exploded and joined, so a key takes a row for each block that holds it, not for
each time it occurs, and no key meets a block twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_numbers() -> Iterator[int]:
    """Different numbers in every task; a task that runs again gives the same ones."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def looked_up(blocks: DataFrame, keys: str, table: DataFrame) -> DataFrame:
    """block and found (at, n): for the keys of each row of ``blocks`` that are in ``table`` (key, n), the place in the list and n."""
    rows = blocks.select("block", F.posexplode(keys).alias("at", "key"))
    found = rows.join(table.select("key", "n"), "key").groupBy("block")
    return found.agg(F.collect_list(F.struct("at", "n")).alias("found"))


def placed(found: pa.StructArray | None, size: int) -> np.ndarray:
    """The n of each place of a list of keys, 0 for a key that was not found."""
    out = np.zeros(size, np.int64)
    if found is not None and len(found):
        out[found.field("at").to_numpy(zero_copy_only=False)] = found.field("n").to_numpy(zero_copy_only=False)
    return out
