"""Statistics of a label per bin of a feature."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import numeric_label, psi, safe_div
from ..sources.scratch import settled, written
from . import cells, many
from .binning import GROUPS_PER_PASS, bin_edges, bin_sql_of_group, bin_struct, check_bins, clean_number, feature_rows, round_edges

GROUP = "_group_number"
COUNTS = ["bin_num", "bad_num", "good_num"]
# The statistics of a bin, in their order.
STATS = [
    *COUNTS,
    "bin_rate", "bad_rate", "good_rate", "odds",
    "global_bad_rate", "global_good_rate",
    "cum_bin_bad_rate", "cum_bin_good_rate",
    "cum_global_bad_rate", "cum_global_good_rate",
    "lift",
]

BIN_COLUMNS = {"bin": "bin", "lo": "bin_lo", "hi": "bin_hi", "label": "bin_label"}
# try_divide gives null for a zero denominator.
RATES = {
    "bin_rate": "try_divide(bin_num, _all_bin_num)",
    "bad_rate": "try_divide(bad_num, bin_num)",
    "global_bad_rate": "try_divide(bad_num, _all_bad_num)",
    "global_good_rate": "try_divide(good_num, _all_good_num)",
    "cum_bin_bad_rate": "try_divide(_cum_bad_num, _cum_bin_num)",
    "cum_bin_good_rate": "try_divide(_cum_good_num, _cum_bin_num)",
    "cum_global_bad_rate": "try_divide(_cum_bad_num, _all_bad_num)",
    "cum_global_good_rate": "try_divide(_cum_good_num, _all_good_num)",
    "total_bad_rate": "try_divide(_all_bad_num, _all_bin_num)",
}


def bin_stat(
    df: DataFrame,
    x: str | list[str],
    label: str,
    pred: str | None = None,
    bins=10,
    cut_method: str = "quantile",
    ascending: bool = True,
    closed: str = "right",
    precision: int | None = 3,
    fillna: str | None = None,
    method: str = "exact",
    group: tuple[Column, list[str], str] | None = None,
    stat_cols: list[str] | None = None,
) -> DataFrame:
    """One row per feature and bin: counts, rates, odds, running rates, lift and, with `pred`, PSI.

    Features are binned together: each row becomes one small ``(feature, bin,
    label)`` row per feature, summed before the shuffle, so the shuffle carries
    at most one row per bin and task. A scan takes as many features as compile
    well, and reads their columns only. Rows without a bin are left out unless
    `fillna` names them; they then form bin 0.

    `group` is used by the reports by date: a group number column, the name of
    each group and the result column; edges are then computed inside every group.
    """
    columns = [x] if isinstance(x, str) else list(x)
    explicit = check_bins(bins, cut_method, closed)
    number, names, group_name = group or (None, [None], None)
    # Several scans read these columns; a join or a grouping behind them is run once.
    needed = [F.col(f"`{c}`") for c in dict.fromkeys([*columns, label, *([pred] if pred is not None else [])])]
    if number is not None:
        name = GROUP
        while name in df.columns:
            name = f"_{name}"
        needed.append(number.alias(name))
        number = F.col(name)
    df = settled(df.select(*needed))
    if not explicit and len(names) * len(columns) > GROUPS_PER_PASS:
        return _bin_stat_of_many(df, columns, label, pred, bins, cut_method, ascending, closed, precision, fillna, method, number, names, group_name, stat_cols)
    edges = bin_edges(df, columns, bins, cut_method, closed, method, number, len(names))
    width = len(columns)

    types = dict(df.dtypes)
    y = [numeric_label(F.col(f"`{c}`"), types[c]).alias(n) for c, n in ((label, "_y"), (pred, "_p")) if c is not None]
    # Features by number, so that no name of theirs can be one of ours.
    features = [F.col(f"`{c}`").alias(f"_x{i}") for i, c in enumerate(columns)]
    rows = df.select(*features, (F.lit(0) if number is None else number).alias("_g"), *y)
    batches: list[list[int]] = [[]]
    numbers, checks = [], 0
    for i in range(width):
        mine = [edges[g * width + i] for g in range(len(names))]
        b = bin_sql_of_group(f"_x{i}", mine, closed)
        numbers.append(f"coalesce({b}, 0)" if fillna is not None else b)
        checks += sum(map(len, mine))
        if batches[-1] and checks > cells.COMPILED_CHECKS:
            batches.append([])
            checks = sum(map(len, mine))
        batches[-1].append(i)
    counted = reduce(
        DataFrame.unionByName,
        [_count_bins(rows, {i: numbers[i] for i in batch}, pred is not None) for batch in batches],
    )
    stats = rate_columns(counted, ["_g", "_f"], "_b", ascending)
    if pred is not None:
        stats = stats.withColumn("psi", psi(safe_div("_pred_sum", "_pred_num"), F.col("bad_rate")))

    shown = [e if explicit else round_edges(e, precision, closed) for e in edges]
    described = cells.by_group(f"_g * {width} + _f", [bin_struct("_b", e, closed, fillna) for e in shown])
    wanted = [*STATS, *(["psi"] if pred is not None else []), "total_bad_rate"]
    return (
        stats.withColumns({"_d": F.expr(described), "feature": F.get(F.array(*map(F.lit, columns)), F.col("_f"))})
        .withColumn(group_name or "_group", F.get(F.array(*map(F.lit, names)), F.col("_g")))
        .orderBy("_g", "_f", F.col("_b").asc() if ascending else F.col("_b").desc())
        .select(
            *([group_name] if group else []),
            "feature",
            *[F.col(f"_d.{name}").alias(alias) for name, alias in BIN_COLUMNS.items()],
            *(stat_cols or wanted),
        )
    )


def _bin_stat_of_many(df, columns, label, pred, bins, cut_method, ascending, closed, precision, fillna, method, number, names, group_name, stat_cols) -> DataFrame:
    """`bin_stat` with the edges of all groups and features in a table that is joined by group, so that no expression grows with them."""
    width, types = len(columns), dict(df.dtypes)
    group = F.lit(0) if number is None else number
    edges = written(many.edge_rows(feature_rows(df, columns, number), bins, cut_method, precision, closed, method), "edges")
    y = [numeric_label(F.col(f"`{c}`"), types[c]).alias(n) for c, n in ((label, "_y"), (pred, "_p")) if c is not None]
    values = F.array(*[clean_number(f"`{c}`") for c in columns])
    rows = df.select(group.cast("int").alias("_g"), *y, F.posexplode(values).alias("_f", "_v")).where("_g IS NOT NULL")
    rows = rows.withColumn("g", F.col("_g") * width + F.col("_f"))
    # Where bins are few against rows, a row of edges meets many rows of its group: AQE splits those.
    binned = rows.join(edges.select("g", "edges"), "g", "left")
    bin_number = many.bin_of("_v", "edges", closed, bins + 1)
    binned = binned.withColumn("_b", F.expr(f"coalesce({bin_number}, 0)" if fillna is not None else bin_number)).where("_b IS NOT NULL")
    sums = [F.count("_y").alias("bin_num"), F.coalesce(F.sum("_y"), F.lit(0)).alias("bad_num")]
    if pred is not None:
        sums += [F.sum("_p").alias("_pred_sum"), F.count("_p").alias("_pred_num")]
    counted = binned.groupBy("_g", "_f", "_b").agg(*sums)
    stats = rate_columns(counted, ["_g", "_f"], "_b", ascending)
    if pred is not None:
        stats = stats.withColumn("psi", psi(safe_div("_pred_sum", "_pred_num"), F.col("bad_rate")))
    named = df.sparkSession.createDataFrame(list(enumerate(names)), f"_g int, _name string")
    shown = edges.select("g", "shown")
    stats = stats.withColumn("g", F.col("_g") * width + F.col("_f")).join(shown, "g", "left").join(named, "_g", "left")
    wanted = [*STATS, *(["psi"] if pred is not None else []), "total_bad_rate"]
    return (
        stats.withColumns({"_d": many.described("shown", "_b", closed, fillna), "feature": F.get(F.array(*map(F.lit, columns)), F.col("_f"))})
        .orderBy("_g", "_f", F.col("_b").asc() if ascending else F.col("_b").desc())
        .select(
            *([F.col("_name").alias(group_name)] if group_name else []),
            "feature",
            *[F.col(f"_d.{name}").alias(alias) for name, alias in BIN_COLUMNS.items()],
            *(stat_cols or wanted),
        )
    )


def _count_bins(rows: DataFrame, numbers: dict[int, str], with_pred: bool) -> DataFrame:
    """Counts and sums of some features per group and bin, in one scan of their columns.

    Bins are made inside `inline`, so that the filter on them does not repeat
    their expressions.
    """
    kept = ["_g", "_y", *(["_p"] if with_pred else [])]
    pairs = ", ".join(f"named_struct('_f', {i}, '_b', {number})" for i, number in numbers.items())
    binned = rows.selectExpr(*kept, f"inline(array({pairs}))")
    sums = [F.count("_y").alias("bin_num"), F.coalesce(F.sum("_y"), F.lit(0)).alias("bad_num")]
    if with_pred:
        sums += [F.sum("_p").alias("_pred_sum"), F.count("_p").alias("_pred_num")]
    return binned.where("_b IS NOT NULL AND _g IS NOT NULL").groupBy("_g", "_f", "_b").agg(*sums)


def rate_columns(counted: DataFrame, keys: list[str], order: str, ascending: bool = True) -> DataFrame:
    """Rates, shares and running rates from ``bin_num`` and ``bad_num`` per bin.

    The windows run over one row per bin.
    """
    whole = Window.partitionBy(*keys)
    running = (
        whole.orderBy(F.col(order).asc() if ascending else F.col(order).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = counted.withColumn("good_num", F.col("bin_num") - F.col("bad_num"))
    summed = counted.select(
        "*",
        *[F.sum(c).over(running).alias(f"_cum_{c}") for c in COUNTS],
        *[F.sum(c).over(whole).alias(f"_all_{c}") for c in COUNTS],
    )
    return summed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in RATES.items()]).selectExpr(
        "*", "1D - bad_rate AS good_rate", "try_divide(1D - bad_rate, bad_rate) AS odds",
        "try_divide(cum_bin_bad_rate, total_bad_rate) AS lift",
    )
