"""Precision, recall and target types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .roc import scored_rows

CLASS_STATS = ["balanced_acc", *[f"{s}_{k}" for s in ("precision", "recall", "f1", "support") for k in (0, 1)]]


def class_columns(tp: str = "tp", fp: str = "fp", pos: str = "pos", neg: str = "neg") -> list[str]:
    """SQL texts of the class metrics, from the weights of both classes and of those above the threshold.

    A metric whose denominator is 0 is 0. Balanced accuracy is the mean recall
    of the classes that occur.
    """
    right = {1: tp, 0: f"({neg} - {fp})"}
    predicted = {1: f"({tp} + {fp})", 0: f"({pos} + {neg} - {tp} - {fp})"}
    actual = {1: pos, 0: neg}
    columns = [
        f"CASE WHEN {pos} = 0 THEN try_divide({right[0]}, {neg}) WHEN {neg} = 0 THEN try_divide({tp}, {pos}) "
        f"ELSE ({right[0]} / {neg} + {tp} / {pos}) / 2D END AS balanced_acc"
    ]
    for name, below in (("precision", predicted), ("recall", actual)):
        columns += [f"coalesce(try_divide({right[k]}, {below[k]}), 0D) AS {name}_{k}" for k in (0, 1)]
    columns += [
        f"coalesce(try_divide(2D * {right[k]}, {predicted[k]} + {actual[k]}), 0D) AS f1_{k}" for k in (0, 1)
    ]
    return [*columns, f"{neg} AS support_0", f"{pos} AS support_1"]


def classification_stats(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float,
    weight: str | None = None,
    pos_label=1,
    keys: list[str] | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support of class 0 and 1, and balanced accuracy.

    The prediction is ``score > threshold``. One group-by of four sums.
    """
    keys = list(keys or [])
    above = f"score > {float(threshold)!r}D"
    sums = scored_rows(df, label, score, weight, pos_label, keys).groupBy(*keys).agg(
        F.expr(f"sum(CASE WHEN hit AND {above} THEN w ELSE 0 END) AS tp"),
        F.expr(f"sum(CASE WHEN NOT hit AND {above} THEN w ELSE 0 END) AS fp"),
        F.expr("sum(CASE WHEN hit THEN w ELSE 0 END) AS pos"),
        F.expr("sum(CASE WHEN hit THEN 0 ELSE w END) AS neg"),
    )
    return sums.selectExpr(*keys, *class_columns())


def _value(df: DataFrame, column: str) -> tuple[Column, bool]:
    data_type = df.schema[column].dataType
    c = F.col(f"`{column}`")
    return c, isinstance(data_type, (T.FractionalType, T.DecimalType))


def target_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Type of target per column: continuous, binary or multiclass; see `first_look`."""
    return first_look(df, columns)[0]


def first_look(df: DataFrame, columns: list[str], also: list[Column] = ()) -> tuple[dict[str, str], Row]:
    """Type of target per column: continuous, binary or multiclass.

    Continuous if any value is not whole, else binary if at most two values
    occur. Instead of counting distinct values, a second scan looks for one
    that is neither the minimum nor the maximum; neither scan shuffles rows.
    The first one takes more aggregates along, whose values come back beside the types.
    """
    parts = []
    for i, name in enumerate(columns):
        c, fractional = _value(df, name)
        parts += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        fraction = F.bool_or(c != F.floor(c)) if fractional else F.lit(False)
        parts.append(fraction.alias(f"fraction{i}"))
    row = df.agg(*parts, *also).first()
    result = {name: "continuous" for i, name in enumerate(columns) if row[f"fraction{i}"]}
    whole = [(i, name) for i, name in enumerate(columns) if name not in result]
    if whole:
        between = df.agg(
            *[
                F.bool_or(~F.col(f"`{name}`").isin(row[f"lo{i}"], row[f"hi{i}"])).alias(f"m{i}")
                if row[f"lo{i}"] is not None
                else F.lit(False).alias(f"m{i}")
                for i, name in whole
            ]
        ).first()
        result.update({name: "multiclass" if between[f"m{i}"] else "binary" for i, name in whole})
    return {name: result[name] for name in columns}, row


def target_type(df: DataFrame, column: str) -> str:
    """Type of target of one column."""
    return target_types(df, [column])[column]
