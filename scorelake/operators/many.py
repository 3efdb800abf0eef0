"""Bins of many groups: edges are rows of a table that is joined by group, not text of an expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import cells
from .binning import BRACKETS


def ranked_quantiles(rows: DataFrame, parts: int, rows_per_cell: int = cells.ROWS_PER_CELL) -> DataFrame:
    """(g, values): the values at i/parts, i = 1 ... parts - 1, of every group of ``rows`` (g, v), interpolated linearly.

    The different values of all groups are put in one order by group and value and summed up in cells of that
    order, so a large group is shared by many tasks and small groups share one. The plan is the same for any number of groups.
    """
    counted = written(rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")), "values")
    different = counted.count()
    if different > rows_per_cell:
        tree = cells.CutTree.of(counted, ["g", "v"], different, rows_per_cell, different)
        placed = tree.with_cell(counted, "cell").join(F.broadcast(tree.offsets(counted, F.col("n")).toDF("cell", "before")), "cell")
    else:
        placed = counted.select("*", F.lit(0).alias("cell"), F.lit(0).cast("bigint").alias("before"))
    running = Window.partitionBy("cell").orderBy("g", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stops = placed.select("g", "v", "n", (F.col("before") + F.sum("n").over(running)).alias("stop"))
    stops = written(stops, "stops")
    groups = stops.groupBy("g").agg(F.min(F.col("stop") - F.col("n")).alias("base"), F.sum("n").alias("total"))
    inside = stops.join(groups, "g").selectExpr("g", "v", "total", "stop - n - base AS a", "stop - base AS b")
    # The rank below each quantile and, if it lies between two, the one above.
    numbers = f"sequence(1, {parts - 1})" if parts > 1 else "array()"
    below = f"((total - 1) * i DIV {parts})"
    between = f"(total - 1) * i % {parts} > 0"
    at = f"transform({numbers}, i -> named_struct('i', i, 'low', IF({below} >= a AND {below} < b, v, NULL), 'high', IF({between} AND {below} + 1 >= a AND {below} + 1 < b, v, NULL)))"
    hits = inside.selectExpr("g", "total", f"inline(filter({at}, x -> x.low IS NOT NULL OR x.high IS NOT NULL))")
    found = hits.groupBy("g", "i").agg(F.max("low").alias("low"), F.max("high").alias("high"), F.first("total").alias("total"))
    share = f"((total - 1) * i % {parts}) / double({parts})"
    value = f"CASE WHEN high IS NULL OR low = high THEN low WHEN {share} < 0.5D THEN low + (high - low) * ({share}) ELSE high - (high - low) * (1D - {share}) END"
    values = found.selectExpr("g", f"named_struct('i', i, 'value', {value}) AS x").groupBy("g")
    return values.agg(F.sort_array(F.collect_list("x")).alias("x")).selectExpr("g", "transform(x, q -> q.value) AS values")


def equal_widths(rows: DataFrame, parts: int) -> DataFrame:
    """(g, values): inner edges of bins of equal width between the least and the largest value of each group."""
    ends = rows.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    infinite = "equal widths need finite values: give the edges of a column with infinite ones"
    checked = ends.withColumn("low", F.when(F.expr("low <= double('-inf') OR high >= double('inf')"), F.raise_error(F.lit(infinite)).cast("double")).otherwise(F.col("low")))
    return checked.selectExpr("g", f"transform(sequence(1, {parts - 1}), i -> low + (high - low) / {parts}D * i) AS values" if parts > 1 else "cast(array() AS array<double>) AS values")


def edge_rows(rows: DataFrame, bins: int, cut_method: str, precision: int | None, closed: str, method: str) -> DataFrame:
    """(g, edges, shown): edges of each group of ``rows`` (g, v) from -inf to +inf without duplicates, and as shown in labels."""
    if cut_method != "quantile":
        values = equal_widths(rows, bins)
    elif method == "approx":
        ranks = cells.literal_array([i / bins for i in range(1, bins)])
        made = rows.groupBy("g").agg(F.kll_sketch_agg_double("v", F.lit(cells.SKETCH_K)).alias("sketch"))
        values = made.select("g", F.kll_sketch_get_quantile_double("sketch", ranks).alias("values"))
    else:
        values = ranked_quantiles(rows, bins)
    inner = "array_sort(array_distinct(filter(values, e -> abs(e) < double('inf'))))"
    edges = values.selectExpr("g", f"concat(array(double('-inf')), {inner}, array(double('inf'))) AS edges")
    if precision is None:
        return edges.selectExpr("g", "edges", "edges AS shown")
    towards = "floor" if closed == "left" else "ceil"
    rounded = f"transform(edges, e -> IF(abs({10**precision} * e) >= {2.0**53!r}D, {10**precision} * e / double({10**precision}), {towards}({10**precision} * e) / double({10**precision})))"
    return edges.selectExpr("g", "edges", f"{rounded} AS shown")


def bin_of(value: str, edges: str, closed: str, most: int) -> str:
    """SQL text of the bin of a value by an array column of edges, from 1; null for null."""
    inclusive = closed != "right"
    # Edges run from -inf to +inf, so every number has a bin; the outermost edges belong to theirs.
    number = f"least(greatest(found, 1), size({edges}) - 1)"
    found = cells.count_below(value, edges, most, inclusive=inclusive, finish=number)
    return f"CASE WHEN {value} IS NOT NULL THEN {found} END"


def written_number(x: str) -> str:
    """SQL text that writes a double with the fewest digits that give it back, and with an exponent only below 1e-4 and from 1e16 on."""
    tries = [f"format_string('%.{d}e', {x})" for d in (14, 15, 16)]
    text = f"CASE WHEN double({tries[0]}) = {x} THEN {tries[0]} WHEN double({tries[1]}) = {x} THEN {tries[1]} ELSE {tries[2]} END"
    plain = f"regexp_replace(cast(cast({text} AS decimal(38,20)) AS string), '(\\\\.[0-9]+?)0+$', '$1')"
    science = f"regexp_replace({text}, '\\\\.?0*e', 'e')"
    return (
        f"CASE WHEN {x} = double('inf') THEN 'inf' WHEN {x} = double('-inf') THEN '-inf' "
        f"WHEN {x} <> 0D AND (abs({x}) < 1e-4D OR abs({x}) >= 1e16D) THEN {science} ELSE {plain} END"
    )


def described(shown: str, number: str, closed: str, fillna: str | None) -> Column:
    """``struct<bin, lo, hi, label>`` of a bin number by an array column of edges."""
    left, right = BRACKETS[closed]
    low, high = f"get({shown}, {number} - 1)", f"get({shown}, {number})"
    label = F.expr(f"CASE WHEN {number} > 0 THEN concat('{left}', {written_number(low)}, ', ', {written_number(high)}, '{right}') END")
    if fillna is not None:
        label = F.coalesce(label, F.lit(fillna))
    known = F.expr(f"{number} > 0")
    return F.struct(
        F.expr(number).alias("bin"), F.when(known, F.expr(low)).alias("lo"), F.when(known, F.expr(high)).alias("hi"), label.alias("label")
    )

