"""Performance of a score cut, overall and by date range."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import numeric_label
from .cells import ROWS_PER_CELL, CutTree
from .columns import by_keys
from .dates import RANGE, date_ranges, named, numbered
from .prefix import prefix_sums
from .roc import auc

# The statistics of the table, in their order.
PERFORMANCE_COLUMNS = [
    "GOOD_NUM", "BAD_NUM", "TOTAL", "POP", "ODDS", "TOTAL_BAD_RATE", "GOOD_RATE", "BAD_RATE",
    "GLOBAL_BAD_RATE", "CUM_POP_BAD_RATE", "CUM_GLOBAL_BAD_RATE", "GLOBAL_GOOD_RATE",
    "CUM_GLOBAL_GOOD_RATE", "KS", "LIFT",
]


@by_keys
def performance_table(
    df: DataFrame,
    target: str,
    cut: str,
    ascending: bool = True,
    stat_cols: list[str] | None = None,
    keys: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Fifteen statistics per score cut, every step rounded half to even.

    `cut` may be a column of bins or of any ordered values. Odds and running rates are made from rounded values, and KS compares
    the running bad rate with the running share of goods; both are part of the
    definition of this table.
    """
    keys = list(keys or [])
    y = numeric_label(F.col(f"`{target}`"), dict(df.dtypes)[target])
    counted = (
        df.select(*keys, F.col(f"`{cut}`").alias("SCORE_CUT"), y.alias("_y"))
        .where("SCORE_CUT IS NOT NULL")
        .groupBy(*keys, "SCORE_CUT")
        .agg(F.count("_y").alias("TOTAL"), F.coalesce(F.sum("_y"), F.lit(0)).alias("BAD_NUM"))
        .withColumn("GOOD_NUM", F.expr("TOTAL - BAD_NUM"))
    )
    # Cells by value: any number of cuts is summed by many tasks, a few by one.
    different = math.ceil(1.1 * counted.agg(F.approx_count_distinct(F.xxhash64("SCORE_CUT"))).first()[0])
    cell, place = None, []
    if different > rows_per_cell:
        tree = CutTree.of(counted, ["SCORE_CUT"], different, rows_per_cell, different)
        counted, place = tree.with_cell(counted, "_place"), ["_place"]
        cell = F.col("_place") if ascending else -F.col("_place")
    down = not ascending
    summed = prefix_sums(counted, "SCORE_CUT", ["TOTAL", "BAD_NUM", "GOOD_NUM"], keys, down, cell=cell)
    rates = summed.selectExpr(
        *keys, "SCORE_CUT", *place, "TOTAL", "BAD_NUM", "GOOD_NUM",
        "bround(try_divide(BAD_NUM, TOTAL), 4) AS BAD_RATE",
        "bround(try_divide(GOOD_NUM, TOTAL), 4) AS GOOD_RATE",
        "bround(try_divide(TOTAL, total_TOTAL), 4) AS POP",
        "bround(try_divide(cum_BAD_NUM, cum_TOTAL), 4) AS CUM_POP_BAD_RATE",
        "bround(try_divide(BAD_NUM, total_BAD_NUM), 4) AS GLOBAL_BAD_RATE",
        "bround(try_divide(GOOD_NUM, total_GOOD_NUM), 4) AS GLOBAL_GOOD_RATE",
        # The running rate at the last cut is the rate of all.
        "bround(try_divide(total_BAD_NUM, total_TOTAL), 4) AS _last_pop",
    )
    shares = prefix_sums(rates, "SCORE_CUT", ["GLOBAL_BAD_RATE", "GLOBAL_GOOD_RATE"], keys, down, cell=cell)
    cumulated = shares.select(
        "*",
        F.expr("bround(cum_GLOBAL_BAD_RATE, 4) AS CUM_GLOBAL_BAD"),
        F.expr("bround(cum_GLOBAL_GOOD_RATE, 4) AS CUM_GLOBAL_GOOD"),
        F.expr("bround(total_GLOBAL_BAD_RATE, 4) AS TOTAL_BAD_RATE"),
    ).drop("cum_GLOBAL_BAD_RATE", "cum_GLOBAL_GOOD_RATE")
    cumulated = cumulated.withColumnsRenamed({"CUM_GLOBAL_BAD": "CUM_GLOBAL_BAD_RATE", "CUM_GLOBAL_GOOD": "CUM_GLOBAL_GOOD_RATE"})
    table = cumulated.select(
        "*",
        F.expr("bround(try_divide(1D - BAD_RATE, BAD_RATE), 3) AS ODDS"),
        F.expr("bround(abs(CUM_POP_BAD_RATE - CUM_GLOBAL_GOOD_RATE), 4) AS KS"),
        F.expr("bround(abs(try_divide(CUM_POP_BAD_RATE, _last_pop)), 4) AS LIFT"),
    )
    order = F.col("SCORE_CUT").asc() if ascending else F.col("SCORE_CUT").desc()
    return table.orderBy(*keys, order).select(*keys, "SCORE_CUT", *(stat_cols or PERFORMANCE_COLUMNS))


def performance_by_date(
    df: DataFrame,
    target: str,
    cut: str,
    date_col: str | None = None,
    cutoffs: list | None = None,
    stat_cols: list[str] | None = None,
    score: str | None = None,
    datetime_format: str = "%Y-%m-%d",
    strftime: str = "%Y%m%d",
    ascending: bool = True,
):
    """`performance_table` per date range as a long table, and the AUC per range when a score is given.

    Returns the table, or ``(table, auc)``. Without date or cutoffs there is one
    table over all rows and no ``date_range`` column.
    """
    ranges = []
    if date_col is not None and cutoffs:
        ranges = date_ranges(df, date_col, cutoffs, datetime_format, strftime)
        df = numbered(df, date_col, ranges)
    keys = [RANGE] if date_col is not None and cutoffs else []

    def finished(result: DataFrame) -> DataFrame:
        return named(result, ranges) if keys else result

    table = finished(performance_table(df, target, cut, ascending, stat_cols, keys))
    if score is None:
        return table
    return table, finished(auc(df, target, score, keys=keys))
