"""ROC points, AUC and KS."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clean_number
from .cells import ROWS_PER_CELL, balanced_cuts
from .columns import by_keys
from .prefix import prefix_sums


def scored_rows(
    df: DataFrame, label: str, score: str, weight: str | None = None, pos_label=1, keys: list[str] | None = None
) -> DataFrame:
    """Rows ``(keys, score, hit, w)``. Rows without label, score or weight add no point."""
    is_boolean = dict(df.dtypes)[label] == "boolean"
    hit = F.col(f"`{label}`") == F.lit(bool(pos_label) if is_boolean else pos_label)
    rows = df.select(
        *(keys or []),
        clean_number(f"`{score}`").alias("score"),
        hit.alias("hit"),
        (F.lit(1) if weight is None else clean_number(f"`{weight}`")).alias("w"),
    )
    return rows.where("score IS NOT NULL AND hit IS NOT NULL AND w <> 0")


def score_points(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Weight of both classes per distinct score; summed before the shuffle, so ties cost nothing."""
    return rows.groupBy(*keys, "score").agg(
        F.expr("sum(CASE WHEN hit THEN w ELSE 0 END) AS tp"),
        F.expr("sum(CASE WHEN hit THEN 0 ELSE w END) AS fp"),
    )


def _cumulated(rows: DataFrame, keys: list[str], drop_intermediate: bool, rows_per_cell: int) -> DataFrame:
    """ROC points by descending score, with collinear ones dropped on request."""
    cuts = balanced_cuts(rows, "score", rows_per_cell)
    points = prefix_sums(
        score_points(rows, keys), "score", ["tp", "fp"], keys, descending=True, cuts=cuts, lead=drop_intermediate
    )
    points = points.withColumn("first", F.expr("cum_tp = tp AND cum_fp = fp"))
    if drop_intermediate:
        # A point is kept when the next step differs, or at either end.
        points = points.where("first OR next_tp IS NULL OR next_tp <> tp OR next_fp <> fp")
    return points


@by_keys
def roc_curve(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None = None,
    pos_label=1,
    drop_intermediate: bool = True,
    keys: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """``(keys, threshold, fpr, tpr)``, from the point (0, 0) with threshold inf downwards.

    One point per distinct score. Rates are null when a class is missing.
    """
    keys = list(keys or [])
    rows = scored_rows(df, label, score, weight, pos_label, keys)
    points = _cumulated(rows, keys, drop_intermediate, rows_per_cell)
    point = "named_struct('threshold', score, 'fpr', try_divide(cum_fp, total_fp), 'tpr', try_divide(cum_tp, total_tp))"
    start = (
        "named_struct('threshold', double('inf'), 'fpr', try_divide(0D, total_fp), 'tpr', try_divide(0D, total_tp))"
    )
    return points.selectExpr(*keys, f"inline(CASE WHEN first THEN array({start}, {point}) ELSE array({point}) END)")


@by_keys
def roc_summary(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None = None,
    pos_label=1,
    threshold: float | None = None,
    drop_intermediate: bool = True,
    keys: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Per key: ``auc_trapezoid``, ``auc_right``, ``ks``, class totals ``pos``, ``neg``, and ``tp``, ``fp`` above the threshold.

    `auc_right` is the sum of ``tpr * step of fpr`` over the points that remain
    after dropping collinear ones; the trapezoid does not depend on dropping.
    All numbers come from one grouping by score: every cell is reduced by its
    own task, and one row per cell is combined at the end.
    """
    keys = list(keys or [])
    rows = scored_rows(df, label, score, weight, pos_label, keys)
    cuts = balanced_cuts(rows, "score", rows_per_cell)
    points = prefix_sums(
        score_points(rows, keys), "score", ["tp", "fp"], keys, descending=True, cuts=cuts, lead=drop_intermediate
    )
    keep = "true"
    if drop_intermediate:
        keep = "(next_tp IS NULL OR next_tp <> tp OR next_fp <> fp OR (cum_tp = tp AND cum_fp = fp))"
    above = "false" if threshold is None else f"score > {float(threshold)!r}D"
    points = points.selectExpr(
        *keys, "_cell", "score", "tp", "fp", "total_tp", "total_fp", "cum_tp", "cum_fp", f"{above} AS above", f"{keep} AS keep"
    )
    # Running counts only grow, so the kept point before this one has the largest cum_fp so far.
    earlier = Window.partitionBy(*keys, "_cell").orderBy(F.desc("score"))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    points = points.withColumn("prev_fp", F.max(F.when(F.col("keep"), F.col("cum_fp"))).over(earlier))
    cell_sums = points.groupBy(*keys, "_cell").agg(
        F.expr("sum(fp * (cum_tp - tp / 2D)) AS trapezoid"),
        F.expr("sum(CASE WHEN keep THEN double(cum_tp) * (cum_fp - prev_fp) END) AS inner_right"),
        F.expr("min(CASE WHEN keep THEN cum_tp END) AS first_tp"),
        F.expr("min(CASE WHEN keep THEN cum_fp END) AS first_fp"),
        F.expr("max(CASE WHEN keep THEN cum_fp END) AS last_fp"),
        F.expr("max(abs(try_divide(cum_fp, total_fp) - try_divide(cum_tp, total_tp))) AS ks"),
        F.expr("max(total_tp) AS pos"),
        F.expr("max(total_fp) AS neg"),
        F.expr("sum(CASE WHEN above THEN tp ELSE 0 END) AS tp"),
        F.expr("sum(CASE WHEN above THEN fp ELSE 0 END) AS fp"),
    )
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cell_sums = cell_sums.withColumn("prev_last", F.coalesce(F.max("last_fp").over(before), F.lit(0)))
    right = "coalesce(inner_right, 0) + coalesce(double(first_tp) * (first_fp - prev_last), 0)"
    return (
        cell_sums.groupBy(*keys)
        .agg(
            F.expr("sum(trapezoid) AS trapezoid"),
            F.expr(f"sum({right}) AS right_sum"),
            *[F.expr(f"max({c}) AS {c}") for c in ("ks", "pos", "neg")],
            *[F.expr(f"sum({c}) AS {c}") for c in ("tp", "fp")],
        )
        .selectExpr(
            *keys,
            "try_divide(trapezoid, double(pos) * neg) AS auc_trapezoid",
            "try_divide(right_sum, double(pos) * neg) AS auc_right",
            "ks",
            "pos",
            "neg",
            "tp",
            "fp",
        )
    )


@by_keys
def auc(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None = None,
    pos_label=1,
    rule: str = "trapezoid",
    drop_intermediate: bool = True,
    keys: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Area under the ROC curve per key.

    ``rule="trapezoid"`` is the usual area; ``"right"`` multiplies each step by
    the rate at its right end, as the reports do. They differ on tied scores.
    Null when a class is missing.
    """
    if rule not in ("trapezoid", "right"):
        raise ValueError(f"rule should be 'trapezoid' or 'right', got {rule!r}")
    drops = drop_intermediate and rule == "right"
    summary = roc_summary(df, label, score, weight, pos_label, None, drops, keys, rows_per_cell)
    return summary.select(*(keys or []), F.col(f"auc_{rule}").alias("auc"))


@by_keys
def ks(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None = None,
    pos_label=1,
    keys: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Largest distance between the false and the true positive rate per key."""
    summary = roc_summary(df, label, score, weight, pos_label, None, False, keys, rows_per_cell)
    return summary.select(*(keys or []), "ks")
