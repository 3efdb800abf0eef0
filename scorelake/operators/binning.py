"""Cutting numeric columns into bins."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clean_number
from . import cells
from .quantiles import VALUES_PER_GROUP, grouped_quantiles

log = logging.getLogger(__name__)

CUT_METHODS = ("quantile", "percentile")
GROUPS_PER_PASS = 200
BRACKETS = {"right": ("(", "]"), "left": ("[", ")"), "both": ("[", "]"), "neither": ("(", ")")}


def check_bins(bins, cut_method: str, closed: str) -> list[float] | None:
    """Validate the binning options; explicit edges come back sorted and unique."""
    if cut_method not in CUT_METHODS:
        raise ValueError(f"unknown cut method {cut_method!r}: use one of {', '.join(CUT_METHODS)}")
    if closed not in BRACKETS:
        raise ValueError(f"closed should be one of {', '.join(BRACKETS)}, got {closed!r}")
    if isinstance(bins, Iterable) and not isinstance(bins, str):
        edges = sorted({float(b) for b in bins})
        if len(edges) < 2 or any(map(math.isnan, edges)):
            raise ValueError("explicit bins need at least two different edges")
        return edges
    if isinstance(bins, bool) or not isinstance(bins, int) or bins < 2:
        raise ValueError(f"give edges or a whole number of at least two bins, not {bins!r}")
    return None


def bin_sql(x: str, edges: list[float], closed: str = "right") -> str:
    """SQL text of the bin number of a column; NaN fails every comparison and gets null."""
    x, last = f"double(`{x}`)", len(edges) - 1
    low, high = cells.sql_double(edges[0]), cells.sql_double(edges[-1])
    if len(edges) <= cells.COMPILED_CHECKS:
        test = "<=" if closed == "right" else "<"
        tests = [f"WHEN {x} {test} {cells.sql_double(edges[k])} THEN {k}" for k in range(1, last)]
        below = "" if math.isinf(edges[0]) else f"WHEN {x} < {low} THEN NULL "
        return f"CASE {below}{' '.join(tests)} WHEN {x} <= {high} THEN {last} END"
    number = cells.count_below(x, cells.sql_array(edges), len(edges), inclusive=closed != "right")
    return f"CASE WHEN {x} >= {low} AND {x} <= {high} THEN least(greatest({number}, 1), {last}) END"


def bin_sql_of_group(x: str, edges: list[list[float]], closed: str) -> str:
    """`bin_sql` with the edges of the group ``_g``."""
    checks = sum(map(len, edges))
    if checks <= cells.COMPILED_CHECKS or all(e == edges[0] for e in edges):
        return cells.by_group("_g", [bin_sql(x, e, closed) for e in edges])
    x, mine = f"double(`{x}`)", cells.array_of_group("_g", edges)
    inside = f"{x} >= get(cuts, 0) AND {x} <= element_at(cuts, -1)"
    number = f"CASE WHEN {inside} THEN least(greatest(found, 1), size(cuts) - 1) END"
    return cells.count_below(x, mine, max(map(len, edges)), inclusive=closed != "right", finish=number)


def assign_bin(x: str, edges: list[float], closed: str = "right") -> Column:
    """Bin number of a column from 1, null outside the edges and for null or NaN.

    Bin k holds ``e[k-1] < x <= e[k]`` when closed right, else
    ``e[k-1] <= x < e[k]``; the outermost closed edge belongs to its bin too.
    Edges are literals, so this is a projection that works on streams as well.
    """
    return F.expr(bin_sql(x, edges, closed))


def round_edges(edges: list[float], precision: int | None, closed: str) -> list[float]:
    """Edges as shown in labels: up to `precision` digits, downwards when closed left."""
    if precision is None:
        return edges
    scale, towards = 10**precision, math.floor if closed == "left" else math.ceil
    return [e if math.isinf(e) else towards(scale * e) / scale for e in edges]


def interval_labels(edges: list[float], closed: str = "right") -> list[str]:
    """Text of each bin, such as ``(569.0, 600.0]``."""
    left, right = BRACKETS[closed]
    return [f"{left}{a!r}, {b!r}{right}" for a, b in zip(edges, edges[1:])]


def bin_struct(number: str, shown: list[float], closed: str, fillna: str | None) -> str:
    """SQL text of ``struct<bin, lo, hi, label>`` for a bin number, looked up in literals."""
    labels = ", ".join(f"'{t}'" for t in interval_labels(shown, closed))
    label = f"get(array({labels}), b - 1)"
    if fillna is not None:
        quoted = fillna.replace("\\", "\\\\").replace("'", "\\'")
        label = f"coalesce({label}, '{quoted}')"
    lows, highs = cells.sql_array(shown[:-1]), cells.sql_array(shown[1:])
    return (
        f"transform(array({number}), b -> named_struct('bin', b, "
        f"'lo', get({lows}, b - 1), 'hi', get({highs}, b - 1), 'label', {label}))[0]"
    )


def feature_rows(df: DataFrame, columns: list[str], group: Column | None = None) -> DataFrame:
    """Long rows ``(g, v)`` of several columns; g = group * columns + column, v without null and NaN."""
    offset = F.lit(0) if group is None else group * len(columns)
    if len(columns) == 1:
        rows = df.select(offset.cast("int").alias("g"), clean_number(f"`{columns[0]}`").alias("v"))
    else:
        pairs = [
            F.struct((offset + i).cast("int").alias("g"), clean_number(f"`{c}`").alias("v"))
            for i, c in enumerate(columns)
        ]
        rows = df.select(F.inline(F.array(*pairs)))
    rows = rows.where(F.col("v").isNotNull())
    return rows if group is None else rows.where(F.col("g").isNotNull())


def bin_edges(
    df: DataFrame,
    columns: list[str],
    bins,
    cut_method: str = "quantile",
    closed: str = "right",
    method: str = "exact",
    group: Column | None = None,
    groups: int = 1,
    rows_per_cell: int = VALUES_PER_GROUP,
) -> list[list[float]]:
    """Edges for every group and column, in the order ``group * len(columns) + column``.

    Computed edges start at -inf and end at +inf and hold no duplicates, since
    ties would otherwise make empty bins. All columns and groups share the same
    few jobs, up to `GROUPS_PER_PASS` of them at a time.
    """
    explicit = check_bins(bins, cut_method, closed)
    total = groups * len(columns)
    if explicit:
        return [explicit] * total
    width = max(1, GROUPS_PER_PASS // groups)
    if len(columns) > width:
        batches = [columns[i : i + width] for i in range(0, len(columns), width)]
        options = (bins, cut_method, closed, method, group, groups, rows_per_cell)
        found = [(batch, bin_edges(df, batch, *options)) for batch in batches]
        return [e for g in range(groups) for batch, edges in found for e in edges[g * len(batch) : (g + 1) * len(batch)]]
    rows = feature_rows(df, columns, group)
    if cut_method == "quantile":
        raw = grouped_quantiles(rows, total, bins, method, ends=False, rows_per_cell=rows_per_cell)
    else:
        raw = [None] * total
        for g, low, high in rows.groupBy("g").agg(F.min("v"), F.max("v")).collect():
            if math.isinf(low) or math.isinf(high):
                raise ValueError("equal widths need finite values: give the edges of a column with infinite ones")
            step = (high - low) / bins
            raw[g] = [low + step * i for i in range(bins + 1)]
    inner = [sorted(set(edges[1:-1])) if edges else [] for edges in raw]
    return [[-math.inf, *(e for e in edges if not math.isinf(e)), math.inf] for edges in inner]


def quantile_edges(
    df: DataFrame, columns: str | list[str], bins: int, method: str = "exact", rows_per_cell: int = VALUES_PER_GROUP
) -> dict[str, list[float] | None]:
    """Values at i/bins of every column, minimum and maximum included.

    Exact by default; ``method="approx"`` reads them from one sketch pass.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    rows = feature_rows(df, columns)
    return dict(zip(columns, grouped_quantiles(rows, len(columns), bins, method, rows_per_cell=rows_per_cell)))


def cut_bin(
    df: DataFrame,
    x: str | list[str],
    bins=10,
    cut_method: str = "quantile",
    closed: str = "right",
    precision: int | None = None,
    fillna: str | None = None,
    retbin: bool = False,
    method: str = "exact",
    suffix: str = "_bin",
):
    """Add a ``struct<bin, lo, hi, label>`` column per feature.

    `bins` is a number of bins or explicit edges. ``"quantile"`` cuts at exact
    quantiles, ``"percentile"`` in equal widths. `precision` rounds computed
    edges in the labels only. Rows without a bin get the label `fillna`. With
    `retbin` the edges per feature are returned too.
    """
    columns = [x] if isinstance(x, str) else list(x)
    explicit = check_bins(bins, cut_method, closed)
    edges = bin_edges(df, columns, bins, cut_method, closed, method)
    added = {}
    for c, e in zip(columns, edges):
        shown = e if explicit else round_edges(e, precision, closed)
        added[c + suffix] = F.expr(bin_struct(bin_sql(c, e, closed), shown, closed, fillna))
    result = df.withColumns(added)
    return (result, dict(zip(columns, edges))) if retbin else result
