"""Reports put together from binning, ROC and class statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.expr import binarize
from ..operators.binstat import COUNTS, bin_stat
from ..operators.classify import CLASS_STATS, class_columns, first_look, target_types
from ..operators.dates import RANGE, DateRange, date_counts, date_ranges, named, numbered, ranges_from
from ..operators.roc import roc_summary
from ..sources.scratch import settled


def _settled(df: DataFrame, *columns: str | list[str] | None) -> DataFrame:
    """The columns of a report, from a frame that its scans can read again and again."""
    names = [n for c in columns if c is not None for n in ([c] if isinstance(c, str) else c)]
    return settled(df.select(*[F.col(f"`{n}`") for n in dict.fromkeys(names)]))


def _check_targets(df: DataFrame, label: str, score: str, also: list[Column] = ()) -> Row:
    types, found = first_look(df, [label, score], also)
    if types[label] != "binary" or types[score] != "continuous":
        raise ValueError("the label must be binary and the score continuous")
    return found


def _model_stats(df, label, score, pos_label, threshold, weight, precision, keys) -> DataFrame:
    """AUC, KS and, with a threshold, class metrics: all from one grouping by score."""
    summary = roc_summary(df, label, score, weight, pos_label, threshold, keys=keys)
    columns = [*keys, "auc_right AS auc", "ks", *(class_columns() if threshold is not None else [])]
    stats = summary.selectExpr(*columns)
    rounded = ["auc", "ks", *(CLASS_STATS if threshold is not None else [])]
    return _rounded(stats, rounded, precision)


def _rounded(df: DataFrame, columns: list[str], precision: int | None) -> DataFrame:
    if precision is None:
        return df
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.bround(F.col(c), precision).alias(c) if c in columns and kinds[c] == "double" else F.col(c)
            for c in df.columns
        ]
    )


def _bin_stats(df, label, score, pos_label, threshold, bin_x, stat_cols, group=None, **options) -> DataFrame | None:
    if bin_x is None:
        return None
    if dict(df.dtypes)[label] == "string":
        df = df.withColumn(label, binarize(f"`{label}`", pos_label))
    pred = None
    if threshold is not None:
        # The decision, not the score, is compared with the bad rate.
        pred = "_decision"
        df = df.withColumn(pred, F.expr(f"int(double(`{score}`) > {float(threshold)!r}D)"))
    return bin_stat(df, bin_x, label, pred, group=group, stat_cols=stat_cols, **options)


def binary_report(
    df: DataFrame,
    label: str,
    score: str,
    pos_label=1,
    threshold: float | None = None,
    bin_x: str | list[str] | None = None,
    bins=10,
    cut_method: str = "quantile",
    ascending: bool = True,
    weight: str | None = None,
    precision: int | None = 5,
    bin_stat_cols: list[str] | None = None,
    method: str = "exact",
    check_types: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """``(stats, bin_stats)`` of a scored binary label.

    `stats` is one row: ``auc`` (right-end rule over the ROC points that remain
    after dropping collinear ones), ``ks`` and, with a threshold, balanced
    accuracy and precision, recall, F1 and support of class 0 and 1. `bin_stats`
    is None without `bin_x`. `ValueError` unless the label is binary and the
    score continuous; `check_types=False` saves those two scans.
    """
    df = _settled(df, label, score, weight, bin_x)
    if check_types:
        _check_targets(df, label, score)
    stats = _model_stats(df, label, score, pos_label, threshold, weight, precision, [])
    binned = _bin_stats(
        df, label, score, pos_label, threshold, bin_x, bin_stat_cols,
        bins=bins, cut_method=cut_method, ascending=ascending, precision=precision, method=method,
    )
    return stats, binned


def binary_report_by_date(
    df: DataFrame,
    label: str,
    score: str,
    date_col: str | None = None,
    cutoffs: list | None = None,
    pos_label=1,
    threshold: float | None = None,
    bin_x: str | list[str] | None = None,
    bins=10,
    cut_method: str = "quantile",
    ascending: bool = True,
    datetime_format: str = "%Y-%m-%d",
    strftime: str = "%Y%m%d",
    date_sep: str = " ~ ",
    bin_stat_cols: list[str] | None = None,
    weight: str | None = None,
    precision: int | None = 5,
    method: str = "exact",
    check_types: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """`binary_report` per date range, both tables with a ``date_range`` column.

    All ranges are computed together, keyed by the range. With a number of bins
    the edges belong to each range; explicit edges are shared, and
    `pivot_by_date` then puts the ranges side by side.
    """
    if date_col is None or not cutoffs:
        return binary_report(
            df, label, score, pos_label, threshold, bin_x, bins, cut_method, ascending, weight, precision,
            bin_stat_cols, method, check_types,
        )
    df = _settled(df, label, score, weight, bin_x, date_col)
    if check_types:
        found = _check_targets(df, label, score, date_counts(date_col, cutoffs, datetime_format))
        ranges = ranges_from(found, cutoffs, datetime_format, strftime, date_sep)
    else:
        ranges = date_ranges(df, date_col, cutoffs, datetime_format, strftime, date_sep)
    dated = numbered(df, date_col, ranges)
    stats = named(_model_stats(dated, label, score, pos_label, threshold, weight, precision, [RANGE]), ranges)
    # Without any range the tables are empty, with the same columns.
    group: tuple[Column, list[str], str] = (F.col(RANGE), [r.label for r in ranges] or [""], "date_range")
    binned = _bin_stats(
        dated, label, score, pos_label, threshold, bin_x, bin_stat_cols, group,
        bins=bins, cut_method=cut_method, ascending=ascending, precision=precision, method=method,
    )
    if binned is not None:
        binned = _rounded(binned, [c for c in binned.columns if c not in (*COUNTS, "bin_lo", "bin_hi")], precision)
    return stats, binned


def pivot_by_date(
    binned: DataFrame,
    ranges: list[DateRange] | list[str],
    stat_cols: list[str],
    index: list[str] | None = None,
) -> DataFrame:
    """The wide form of a table by date: one row per bin, one column ``<range>_<stat>`` each."""
    labels = [r.label if isinstance(r, DateRange) else r for r in ranges]
    index = index or [c for c in ("feature", "bin", "bin_label", "SCORE_CUT") if c in binned.columns]
    values = [F.first(c).alias(c) for c in stat_cols]
    wide = binned.groupBy(*index).pivot("date_range", labels).agg(*values)
    if len(stat_cols) == 1:
        wide = wide.withColumnsRenamed({label: f"{label}_{stat_cols[0]}" for label in labels})
    return wide


def model_report(
    df: DataFrame,
    label: str,
    score: str,
    bin_x: str | list[str] | None = None,
    threshold: float | None = None,
    pos_label=1,
    weight: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The report that suits the targets; `NotImplementedError` for any but a binary label with a continuous score."""
    types = target_types(df, [label, score])
    if types[label] == "binary" and types[score] == "continuous":
        return binary_report(
            df, label, score, pos_label, threshold, bin_x, weight=weight, check_types=False
        )
    raise NotImplementedError(f"no report for a {types[label]} label and a {types[score]} score")
