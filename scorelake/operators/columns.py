"""Choosing, renaming and joining columns; small row operators."""

from __future__ import annotations

import functools
import inspect
import logging
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import human_size

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise `ValueError` naming the columns that the frame lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")


def by_keys(function):
    """Lets a report ``function(df, ..., keys=...)`` group by columns of any name.

    Inside, the keys are copies under names of their own. A key with the name of a result column is a `ValueError`.
    """
    order = list(inspect.signature(function).parameters)
    at = order.index("keys")

    @functools.wraps(function)
    def grouped(df: DataFrame, *args, **options) -> DataFrame:
        given = args[at - 1] if len(args) >= at else options.get("keys")
        keys = list(given or [])
        if not keys:
            return function(df, *args, **options)
        require_columns(df, keys)
        names = [f"key_number_{i}" for i in range(len(keys))]
        while set(names) & {c.lower() for c in df.columns}:
            names = [f"{n}_" for n in names]
        copied = df.withColumns({n: F.col(f"`{k}`") for n, k in zip(names, keys)})
        if len(args) >= at:
            args = (*args[: at - 1], names, *args[at:])
        else:
            options["keys"] = names
        result = function(copied, *args, **options)
        shown = [keys[names.index(c)] if c in names else c for c in result.columns]
        if twice := sorted({k for k in keys if [c.lower() for c in shown].count(k.lower()) > 1}):
            raise ValueError(f"a key has the name of a result column: {', '.join(twice)}")
        return result.toDF(*shown)

    return grouped


def select_columns(df: DataFrame, columns: list[str] | None = None, more: list[str] | None = None) -> DataFrame:
    """A subset of the columns, by default all. A second list is appended, duplicates dropped."""
    wanted = list(dict.fromkeys([*(columns or df.columns), *(more or [])]))
    require_columns(df, wanted)
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def rename_columns(df: DataFrame, names: list[str] | None, on_mismatch: str = "skip") -> DataFrame:
    """Rename all columns by position. A list of the wrong length is skipped with a warning, or an error."""
    if not names:
        return df
    if len(names) != len(df.columns):
        message = f"{len(df.columns)} columns but {len(names)} names"
        if on_mismatch != "skip":
            raise ValueError(message)
        log.warning("%s, rename skipped", message)
        return df
    return df.toDF(*names)


def strip_qualifiers(df: DataFrame) -> DataFrame:
    """Column names without their table: ``t.price`` becomes ``price``."""
    return df.toDF(*[c.rpartition(".")[2] for c in df.columns])


def select_regex(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose whole name matches the pattern."""
    return df.select(df.colRegex(f"`{pattern}`"))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but the given ones."""
    require_columns(df, list(columns))
    return df.drop(*columns)


def join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join; the strategy is left to the optimizer and AQE."""
    return left.join(right, list(keys), "inner")


def usage_report(
    left: DataFrame, right: DataFrame, key: str, measure: str, human_readable: bool = True, ascending: bool = True
) -> DataFrame:
    """Inner join on one key, sorted by a size in bytes, which is then shown in readable form."""
    joined = join_on(left, right, [key])
    joined = joined.orderBy(F.col(measure).asc() if ascending else F.col(measure).desc())
    return joined.withColumn(measure, human_size(measure)) if human_readable else joined


def stitch_columns(frames: list[DataFrame], key: str | list[str]) -> DataFrame:
    """Put column slices of the same rows side by side, matched on a row key.

    Every row of every slice stays: a null key matches a null key, and a slice
    without the row leaves its columns null. Keys should be unique in each slice; where one
    repeats, its rows are matched in the order of their digests, the first with the first.
    A column that is no key must be in one slice only, whatever its name; otherwise it is a `ValueError`.

    All slices go through one shuffle by key, however many there are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    for frame in frames:
        require_columns(frame, keys)
    rest = [[c for c in f.columns if c not in keys] for f in frames]
    names = [c.lower() for columns in rest for c in columns]
    if repeated := sorted({c for c in names if names.count(c) > 1}):
        raise ValueError(f"columns in several slices: {', '.join(repeated)}")
    if len(frames) == 1:
        return frames[0].select(*[F.col(f"`{c}`") for c in (*keys, *rest[0])])

    types = [f.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("v")).schema["v"].dataType if columns else None for f, columns in zip(frames, rest)]
    slices = []
    for i, (frame, columns) in enumerate(zip(frames, rest)):
        hashable = [c for c in columns if not _has_map(frame.schema[c].dataType)]
        digest = F.xxhash64(*[F.col(f"`{c}`") for c in hashable]) if hashable else F.lit(0).cast("bigint")
        held = [F.struct(*[F.col(f"`{c}`") for c in columns]) if j == i and columns else F.lit(None).cast(t or "int") for j, t in enumerate(types)]
        slices.append(frame.select(*[F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keys)], F.lit(i).alias("slice"), digest.alias("digest"), *[v.alias(f"v{j}") for j, v in enumerate(held)]))
    inner = [f"k{n}" for n in range(len(keys))]
    moved = reduce(DataFrame.union, slices).repartition(*inner)
    # The shuffle by key serves the numbering and the grouping too.
    turn = F.row_number().over(Window.partitionBy(*inner, "slice").orderBy("digest")).alias("turn")
    numbered = moved.select("*", turn)
    rows = numbered.groupBy(*inner, "turn").agg(*[F.first(f"v{j}", ignorenulls=True).alias(f"v{j}") for j in range(len(frames))])
    found = [F.col(f"v{j}.`{c}`").alias(c) for j, columns in enumerate(rest) for c in columns]
    return rows.select(*[F.col(f"k{n}").alias(k) for n, k in enumerate(keys)], *found)


def stack(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str], descending: bool = False) -> DataFrame:
    """One row per key: the first by the given order; ties fall to the other columns.

    A minimum over structs instead of a ranking window: each task reduces its
    own rows first, so a hot key costs one row per task in the shuffle.
    """
    keys, rest = list(keys), [c for c in df.columns if c not in keys]
    comparable = [c for c in rest if c not in order_by and not _has_map(df.schema[c].dataType)]
    others = [c for c in rest if c not in order_by and c not in comparable]
    ordered = F.struct(*[F.col(f"`{c}`") for c in [*order_by, *comparable]])
    pick, pick_by = (F.max, F.max_by) if descending else (F.min, F.min_by)
    if others:
        row = pick_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordered)
    else:
        row = pick(ordered)
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(row.alias("_row"))
    return picked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`") for c in df.columns])


def _has_map(data_type: T.DataType) -> bool:
    return any(word in data_type.simpleString() for word in ("map<", "variant"))
