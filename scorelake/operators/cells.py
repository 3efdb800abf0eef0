"""Splitting the value range of a column into cells of a known, small size.

Global order over a large table is built from cells: sketches give cut values,
every row finds its cell by comparing with them, and exact counts per cell give
exact positions. Cuts decide only how the work is balanced, never the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.conf import with_conf
from ..sources.scratch import is_scan, written

SKETCH_K = 2048
#: More than the rank error of a KLL sketch of that size, as a share of the rows.
RANK_MARGIN = 0.004
#: Sketches are merged in this many groups before the last merge.
SKETCH_GROUPS = 64
#: Sketches that a task holds at once before it sorts its rows by key instead.
SKETCHES_PER_TASK = 8192
#: Rows looked at to choose a cut between cells of rows.
SAMPLES_PER_CELL = 32
#: Rows are drawn for a sample in steps of one in so many.
DRAWS = 1 << 40
#: Cells per level, and rows a single task is given to sort.
CELLS_PER_LEVEL = 256
ROWS_PER_CELL = 4_000_000
#: Up to this many comparisons are written out in one expression. Longer code is
#: refused by the JIT compiler and runs many times slower than bisection.
COMPILED_CHECKS = 100


def sql_double(value: float) -> str:
    """A double literal in SQL text."""
    return f"double('{value}')" if math.isinf(value) else f"{float(value)!r}D"


def sql_array(values: list[float]) -> str:
    """An array<double> literal in SQL text."""
    if not values:
        return "cast(array() AS array<double>)"
    return f"cast(split('{','.join(map(repr, values))}', ',') AS array<double>)"


def literal_array(values: list, type_name: str = "double") -> Column:
    """An array literal, parsed once from text."""
    if not values:
        return F.array().cast(f"array<{type_name}>")
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{type_name}>")


def count_below(value: str, cuts: str, size: int, inclusive: bool = False, finish: str = "found") -> str:
    """How many of the sorted cuts are below (or equal to) the value, by bisection, as SQL text.

    Jumps of falling powers of two; a cut past the end is null and ends the
    jump. `finish` may use ``found`` and ``cuts``, which are evaluated once.
    """
    jumps = ",".join(str(2**k) for k in reversed(range(size.bit_length())))
    test = "<=" if inclusive else "<"
    step = f"CASE WHEN get(cuts, found + jump - 1) {test} {value} THEN found + jump ELSE found END"
    search = f"aggregate(array({jumps}), 0, (found, jump) -> {step}, found -> {finish})"
    return f"transform(array({cuts}), cuts -> {search})[0]"


def cell_of(value: str, cuts: list[float]) -> str:
    """SQL text of the cell of a value: ``2 * cuts below it``, plus 1 when it equals a cut.

    Odd cells hold a single value, so a hot value never makes a cell large.
    """
    if not cuts:
        return "0"
    if 2 * len(cuts) <= COMPILED_CHECKS:
        tests = [
            f"WHEN {value} < {sql_double(c)} THEN {2 * i} WHEN {value} = {sql_double(c)} THEN {2 * i + 1}"
            for i, c in enumerate(cuts)
        ]
        return f"CASE {' '.join(tests)} ELSE {2 * len(cuts)} END"
    return cell_in(value, sql_array(cuts), len(cuts))


def cell_in(value: str, cuts: str, size: int) -> str:
    """`cell_of` for cuts in an array expression of at most the given size."""
    finish = f"2 * found + int(coalesce(get(cuts, found) = {value}, false))"
    return count_below(value, cuts, size, finish=finish)


def array_of_group(group: str, arrays: list[list[float]]) -> str:
    """SQL text of the array belonging to a group number."""
    return f"get(array({', '.join(map(sql_array, arrays))}), {group})"


def by_group(group: str | None, choices: list[str]) -> str:
    """SQL text that picks the expression belonging to a group number."""
    if group is None or len(set(choices)) == 1:
        return choices[0]
    return f"CASE {group} {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(choices))} END"


def _row(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def _cuts_at_or_below(value: Column, cuts: Column, most: int) -> Column:
    """How many of the sorted cuts, at most ``most``, lie at or below a row, by bisection; nulls come first."""
    jumps = F.array(*[F.lit(2**k) for k in reversed(range(most.bit_length()))])
    # The row is the start value's field, so that it is put together once.
    found = F.aggregate(
        jumps,
        F.struct(F.lit(0).alias("found"), value.alias("value")),
        lambda s, jump: F.struct(
            F.when((s["found"] + jump <= F.size(cuts)) & (F.get(cuts, s["found"] + jump - 1) <= s["value"]), s["found"] + jump)
            .otherwise(s["found"]).alias("found"),
            s["value"].alias("value"),
        ),
        lambda s: s["found"],
    )
    return found


class CutTree:
    """Cuts by value that split rows in at most 65 536 cells, as a tree of two levels.

    The first level, at most 255 rows, is part of the plan. The second level is a table
    with the cuts inside each cell of the first, so plans and the driver
    stay the same size however many rows there are. Samples are of different rows, chosen by
    digest: the same rows always give the same cuts.
    """

    def __init__(self, columns: list[str], top: list[Row], types: list, lower: DataFrame | None):
        self.columns, self.top, self.types, self.lower = columns, top, types, lower

    @classmethod
    def of(cls, df: DataFrame, columns: list[str], rows: int, rows_per_cell: int = ROWS_PER_CELL, different: int | None = None) -> CutTree:
        """The tree for ``rows`` rows of ``df`` by some of its columns; ``different`` says about how many differ there, if known."""
        keys = df.select(*[F.col(f"`{c}`") for c in columns])
        draw = F.pmod(F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in columns]), F.lit(DRAWS))
        if different is None:
            different = keys.agg(F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in columns]))).first()[0]
        different = max(1, different)
        cells = min(-(-rows // rows_per_cell), CELLS_PER_LEVEL**2)

        def share(wanted: int) -> float:
            return min(1.0, 1.1 * wanted * SAMPLES_PER_CELL / different)

        def sample(wanted: int) -> DataFrame:
            return keys.where(draw < math.ceil(share(wanted) * DRAWS)).distinct()

        first = min(cells, CELLS_PER_LEVEL)
        order = [F.col(f"`{c}`").asc_nulls_first() for c in columns]
        ordered = sample(first).orderBy(*order).collect()
        first = min(first, len(ordered))
        top = [ordered[len(ordered) * i // first] for i in range(1, first)]
        tree = cls(columns, top, [df.schema[c].dataType for c in columns], None)
        if cells > CELLS_PER_LEVEL and top:
            drawn = sample(cells).withColumn("_top", tree._top_cell())
            inside = Window.partitionBy("_top")
            numbered = drawn.select("_top", _row(columns).alias("row"), (F.row_number().over(inside.orderBy(*order)) - 1).alias("i"), F.count("*").over(inside).alias("n"))
            # Every cell in parts of about as many samples as a cell of all has, and no cut at its first row.
            each = max(1.0, share(cells) * different / cells)
            parts = F.least(F.lit(CELLS_PER_LEVEL), F.greatest(F.lit(1), F.floor(F.col("n") / each)))
            part = lambda i: F.floor(i * parts / F.col("n"))
            cuts = numbered.where((F.col("i") > 0) & (part(F.col("i")) > part(F.col("i") - 1)))
            tree.lower = written(cuts.groupBy("_top").agg(F.sort_array(F.collect_list("row")).alias("_cuts")), "cuts")
        return tree

    def _top_cell(self) -> Column:
        if not self.top:
            return F.lit(0)
        rows = [F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(cut, self.types))]) for cut in self.top]
        return _cuts_at_or_below(_row(self.columns), F.array(*rows), len(rows))

    def with_cell(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the cell of each row; cells rise along the order."""
        if self.lower is None:
            return df.withColumn(name, self._top_cell())
        # At most 256 rows.
        top, cuts = f"{name}_top", f"{name}_cuts"
        joined = df.withColumn(top, self._top_cell()).join(F.broadcast(self.lower.toDF(top, cuts)), top, "left")
        below = F.when(F.col(cuts).isNull(), 0).otherwise(_cuts_at_or_below(_row(self.columns), F.col(cuts), CELLS_PER_LEVEL - 1))
        return joined.withColumn(name, F.col(top) * CELLS_PER_LEVEL + below).drop(top, cuts)

    def offsets(self, df: DataFrame, weight: Column | None = None) -> DataFrame:
        """(cell, before): the rows of ``df``, or their weights, in all cells before, for each cell that has rows.

        A written table of at most 65 536 rows.
        """
        weight = F.lit(1).cast("bigint") if weight is None else weight
        weighed = df.select(*[F.col(f"`{c}`") for c in self.columns], weight.alias("_n"))
        counts = self.with_cell(weighed, "_cell").groupBy("_cell").agg(F.sum("_n").alias("n"))
        earlier = Window.partitionBy(F.lit(0)).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        return written(counts.select("_cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "offsets")


def sketch(df: DataFrame, value: str, keys: list[str], ranks: list[float], only: str = "true", then=None) -> list:
    """Rows and approximate quantiles per key, merged as a tree.

    `then` is applied to the table ``(keys, n, quantiles)`` before the driver fetches it. One final task never receives more than `SKETCH_GROUPS` sketches per key.
    `only` is a condition on the rows that are sketched; all rows are counted,
    and keys without sketched rows have no quantiles.
    """
    sketched = F.expr(f"CASE WHEN {only} THEN {value} END")
    made = [F.count(value).alias("n"), F.kll_sketch_agg_double(sketched, F.lit(SKETCH_K)).alias("sketch")]
    if is_scan(df) and df.rdd.getNumPartitions() <= SKETCH_GROUPS:
        merged = df.groupBy(*keys).agg(*made)  # few tasks, so one merge is enough
    else:
        partial = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).groupBy(*keys, "_part").agg(*made)
        merged = partial.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    quantiles = F.kll_sketch_get_quantile_double("sketch", literal_array(ranks))
    has_values = F.kll_sketch_get_n_double("sketch") > 0
    result = merged.select(*keys, "n", F.when(has_values, quantiles).alias("quantiles"))
    # Sketches of more keys than usual are kept side by side: the other way would be to sort all rows.
    if then is not None:
        result = then(result)
    with with_conf(df.sparkSession, {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(SKETCHES_PER_TASK)}):
        return result.collect()


def balanced_cuts(df: DataFrame, value: str, rows_per_cell: int = ROWS_PER_CELL) -> list[float]:
    """Cut values that split the distinct values of a column into sortable cells.

    None when one task can sort them all, else one level of sketches, and a
    second level inside cells that are still too large.
    """
    distinct = df.agg(F.approx_count_distinct(value)).first()[0]
    if distinct * 1.1 <= rows_per_cell:
        return []
    ranks = [i / CELLS_PER_LEVEL for i in range(1, CELLS_PER_LEVEL)]
    whole = sketch(df, value, [], ranks)[0]
    cuts = sorted(set(whole["quantiles"]))
    if whole["n"] <= rows_per_cell * CELLS_PER_LEVEL:
        keep = -(-whole["n"] // rows_per_cell)
        return sorted({whole["quantiles"][(CELLS_PER_LEVEL - 1) * i // keep] for i in range(1, keep)})
    cells = df.withColumn("_cell", F.expr(cell_of(value, cuts))).where("_cell % 2 = 0")
    for row in sketch(cells, value, ["_cell"], ranks):
        if row["n"] > rows_per_cell:
            cuts.extend(row["quantiles"])
    return sorted(set(cuts))
