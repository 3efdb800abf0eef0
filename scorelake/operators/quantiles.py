"""Exact quantiles of columns too large to sort in one place."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import cells

RANK_STEPS = 1000  # quantiles read from each sketch
VALUES_PER_GROUP = 1_000_000  # one task sorts these; more are first narrowed by another scan


class Bracket(NamedTuple):
    """A range of values that should hold a wanted rank; None is no bound."""

    low: float | None
    high: float | None
    rows: float  # expected inside


def _split_position(rows: int, i: int, parts: int) -> tuple[int, float]:
    """Zero-based rank below the quantile i/parts, and how far it lies towards the next rank."""
    below, rest = divmod((rows - 1) * i, parts)
    return below, rest / parts


def _interpolate(low: float, high: float, share: float) -> float:
    if low == high or share == 0:
        return low
    return low + (high - low) * share if share < 0.5 else high - (high - low) * (1 - share)


def grouped_quantiles(
    rows: DataFrame,
    groups: int,
    parts: int,
    method: str = "exact",
    ends: bool = True,
    rows_per_cell: int = VALUES_PER_GROUP,
) -> list[list[float] | None]:
    """The values at i/parts (i = 0 … parts) for every group, interpolated linearly.

    `rows` has a group number ``g`` below `groups` and a double ``v`` without
    null or NaN. A group without rows yields None. Without `ends` the minimum
    and the maximum are not searched and come out as infinite.

    Exact selection narrows brackets around the wanted ranks. A scan counts the
    rows of every bracket and gap, and sketches the values inside brackets, from
    which tighter brackets follow. When few enough rows are inside, a last scan
    groups their values and reads the wanted ones off. Sketches only choose
    where to look; a rank outside its bracket shows in the counts, and the gap
    that holds it becomes the next bracket. The driver sees bounds and counts.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"method should be 'exact' or 'approx', got {method!r}")
    positions = range(parts + 1) if ends else range(1, parts)
    if method == "approx":
        sketched = cells.sketch(rows, "v", ["g"], [i / parts for i in range(parts + 1)])
        approximate = {r["g"]: list(r["quantiles"]) for r in sketched}
        if not ends:
            approximate = {g: [-math.inf, *q[1:-1], math.inf] for g, q in approximate.items()}
        return [approximate.get(g) for g in range(groups)]

    sizes: dict[int, int] = {}
    pending: dict[int, set[int]] = {}  # zero-based ranks to find
    found: dict[int, dict[int, float]] = {g: {} for g in range(groups)}
    brackets = {g: {Bracket(None, None, math.inf)} for g in range(groups)}
    while brackets:
        placement = _Placement(brackets, groups)
        if max(sum(b.rows for b in mine) for mine in brackets.values()) > rows_per_cell:
            counted = _count_and_sketch(rows, placement, _ranks_of(pending, groups, positions, parts))
            if not sizes:
                sizes = {g: sum(n for _, n, _ in counted[g]) for g in counted}
                pending = {g: _ranks(n, positions, parts) for g, n in sizes.items()}
            brackets = _tighten(counted, placement, pending, found)
        else:
            brackets = _read_values(rows, placement, pending, found)

    edges: list[list[float] | None] = []
    for g in range(groups):
        if not sizes.get(g):
            edges.append(None)
            continue
        values = [-math.inf] * (parts + 1)
        values[-1] = math.inf
        for i in positions:
            below, share = _split_position(sizes[g], i, parts)
            low = found[g][below]
            values[i] = _interpolate(low, found[g][below + 1], share) if share else low
        edges.append(values)
    return edges


def _ranks(rows: int, positions: range, parts: int) -> set[int]:
    """Ranks whose values the quantiles at the given positions are made of."""
    split = [_split_position(rows, i, parts) for i in positions]
    return {below for below, _ in split} | {below + 1 for below, share in split if share}


class _Placement:
    """Cells between the bounds of all brackets, per group, and SQL text to find them."""

    def __init__(self, brackets: dict[int, set[Bracket]], groups: int):
        self.cuts: list[list[float]] = []
        self.inside: list[list[int]] = []  # open cells that lie in a bracket
        for g in range(groups):
            mine = brackets.get(g, set())
            cuts = sorted({v for b in mine for v in (b.low, b.high) if v is not None})
            ends = [None, *cuts, None]
            self.cuts.append(cuts)
            self.inside.append(
                [2 * i for i in range(len(cuts) + 1) if any(_covers(b, ends[i], ends[i + 1]) for b in mine)]
            )

    def cell(self) -> str:
        """Cell of a value ``v`` of a group ``g``."""
        checks = 2 * sum(map(len, self.cuts))
        if checks <= cells.COMPILED_CHECKS or len(self.cuts) == 1:
            return cells.by_group("g", [cells.cell_of("v", cuts) for cuts in self.cuts])
        return cells.cell_in("v", cells.array_of_group("g", self.cuts), max(map(len, self.cuts)))

    def kept(self) -> str:
        """Is the cell ``c`` inside a bracket?"""
        if len(self.inside) > 8:
            return f"array_contains({cells.array_of_group('g', self.inside)}, double(c))"
        tests = [f"c IN ({', '.join(map(str, k))})" if k else "false" for k in self.inside]
        return cells.by_group("g", tests)

    def ends(self, g: int, c: int) -> tuple[float | None, float | None]:
        """Bounds of an open cell."""
        ends = [None, *self.cuts[g], None]
        return ends[c // 2], ends[c // 2 + 1]


def _covers(b: Bracket, low: float | None, high: float | None) -> bool:
    return (b.low is None or (low is not None and b.low <= low)) and (
        b.high is None or (high is not None and high <= b.high)
    )


def _count_and_sketch(rows: DataFrame, placement: _Placement, wanted: str) -> dict[int, list[tuple]]:
    """Per group, ``(cell, rows, bounds)`` of every cell.

    `wanted` is SQL text of the ranks to find, an array that may use ``total``, the rows of the group.
    Bounds hold ``(low, high, share)`` for each wanted rank in a cell that was
    sketched, and are None for other cells: the driver gets no more than it needs.
    """
    steps = [i / RANK_STEPS for i in range(RANK_STEPS + 1)]
    lower = f"int(greatest(0, floor(((r - start) / n - {cells.RANK_MARGIN}D) * {RANK_STEPS})))"
    upper = f"int(least({RANK_STEPS}, ceil(((r - start) / n + {cells.RANK_MARGIN}D) * {RANK_STEPS})))"
    bounds = f"named_struct('rank', bigint(r), 'low', quantiles[{lower}], 'high', quantiles[{upper}], 'steps', {upper} - {lower})"

    def pick(merged: DataFrame) -> DataFrame:
        # These windows run over the cells of a group, a few for each bracket.
        cells_of = Window.partitionBy("g")
        before = cells_of.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
        placed = merged.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("total", F.sum("n").over(cells_of))
        inside = f"filter({wanted}, r -> r >= start AND r < start + n)"
        return placed.selectExpr("g", "c", "n", f"CASE WHEN quantiles IS NOT NULL THEN transform({inside}, r -> {bounds}) END AS bounds")

    placed = rows.select("g", "v", F.expr(placement.cell()).alias("c"))
    counted: dict[int, list[tuple]] = {}
    for row in cells.sketch(placed, "v", ["g", "c"], steps, placement.kept(), pick):
        found = row["bounds"] if row["bounds"] is None else {b["rank"]: (b["low"], b["high"], b["steps"]) for b in row["bounds"]}
        counted.setdefault(row["g"], []).append((row["c"], row["n"], found))
    return {g: sorted(mine, key=lambda r: r[0]) for g, mine in counted.items()}


def _ranks_of(pending: dict[int, set[int]], groups: int, positions: range, parts: int) -> str:
    """SQL text of the ranks to find in a group; before its size is known, of those that follow from ``total``."""
    if pending:
        return cells.array_of_group("g", [sorted(map(float, pending.get(g, ()))) for g in range(groups)])
    numbers = ", ".join(f"{i}L" for i in positions)
    below = f"((total - 1) * i DIV {parts})"
    both = f"IF((total - 1) * i % {parts} > 0, array({below}, {below} + 1), array({below}))"
    return f"array_distinct(flatten(transform(array({numbers}), i -> {both})))"


def _tighten(counted: dict, placement: _Placement, pending: dict, found: dict) -> dict[int, set[Bracket]]:
    """Brackets around the ranks that are still open, from exact counts and sketches."""
    brackets: dict[int, set[Bracket]] = {}
    for g, mine in counted.items():
        below = 0
        for c, n, bounds in mine:
            for rank in [r for r in pending[g] if below <= r < below + n]:
                if c % 2:
                    found[g][rank] = placement.cuts[g][c // 2]
                    pending[g].discard(rank)
                elif bounds is None:
                    brackets.setdefault(g, set()).add(Bracket(*placement.ends(g, c), n))
                else:
                    low, high, steps = bounds[rank]
                    expected = 0 if low == high else n * steps / RANK_STEPS
                    brackets.setdefault(g, set()).add(Bracket(low, high, expected))
            below += n
    return brackets


def _read_values(rows: DataFrame, placement: _Placement, pending: dict, found: dict) -> dict[int, set[Bracket]]:
    """Group the values inside brackets and read off the wanted ranks.

    All other rows of a cell become one count, so a group has few enough rows
    for one task to sort. Returns the gaps that hold a rank, if any.
    """
    counted = (
        rows.select("g", "v", F.expr(placement.cell()).alias("c"))
        .groupBy("g", "c", F.expr(f"CASE WHEN {placement.kept()} THEN v END").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("g").orderBy("c", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = [sorted(pending.get(g, ())) for g in range(len(placement.cuts))]
    hits = (
        counted.withColumn("stop", F.sum("n").over(running))
        .selectExpr("g", "c", "v", "stop - n AS start", "stop")
        .where(cells.by_group("g", [_holds_any(ranks) for ranks in wanted]))
    )
    missed: dict[int, set[Bracket]] = {}
    for row in hits.collect():
        g, c = row["g"], row["c"]
        value = placement.cuts[g][c // 2] if c % 2 else row["v"]
        if value is None:
            missed.setdefault(g, set()).add(Bracket(*placement.ends(g, c), row["stop"] - row["start"]))
            continue
        for rank in wanted[g]:
            if row["start"] <= rank < row["stop"]:
                found[g][rank] = value
                pending[g].discard(rank)
    return missed


def _holds_any(ranks: list[int]) -> str:
    """SQL text: does the run of rows from start to stop hold one of the ranks?"""
    return " OR ".join(f"(start <= {r}L AND stop > {r}L)" for r in ranks) or "false"
