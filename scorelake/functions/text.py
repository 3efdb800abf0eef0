"""Cleaning of text cells."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import col


def _unescape_udf():
    # Defined inside a function so that it is pickled by value: executors need
    # no copy of this package.
    def unescape(cells: pd.Series) -> pd.Series:
        import html
        import unicodedata

        return cells.map(lambda s: unicodedata.normalize("NFKC", html.unescape(s)), na_action="ignore")

    return F.pandas_udf(unescape, "string")


def clean_text(text: Column | str) -> Column:
    """``"NULL"`` becomes empty, HTML entities are resolved, Unicode is put in NFKC form.

    Spark has no built-in for the last two. Only cells with an ``&`` or a
    character outside ASCII can change, so only those travel to Python.
    """
    text = col(text)
    may_change = F.when(text.rlike(r"[&]|[^\x00-\x7F]"), text)
    return F.when(text == "NULL", "").otherwise(F.coalesce(_unescape_udf()(may_change), text))


def clean_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """`clean_text` on the given columns, by default on every string column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: clean_text(F.col(f"`{c}`")) for c in columns})
