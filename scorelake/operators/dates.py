"""Cutting rows by date ranges."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateRange:
    """A half-open range of dates with its label and row count."""

    label: str
    start: dt.datetime
    end: dt.datetime
    rows: int


def _as_date(value, datetime_format: str) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.strptime(value, datetime_format)


def _literal(value: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"


def date_ranges(
    df: DataFrame,
    date_col: str,
    cutoffs: list,
    datetime_format: str = "%Y-%m-%d",
    strftime: str = "%Y%m%d",
    sep: str = " ~ ",
) -> list[DateRange]:
    """Ranges between cutoffs, from the first date to the last one included.

    The smallest date is put before the sorted cutoffs and the largest after
    them, without sorting again, unless a cutoff given as a date equals it; one
    day is added to the last bound. A range without rows is skipped and its
    start carried over to the label of the next one. Labels read ``start ~ end``
    with the last day included.

    One job counts the rows between cutoffs and finds both ends; the ranges are
    then made from these few numbers.
    """
    found = df.agg(*date_counts(date_col, cutoffs, datetime_format)).first()
    return ranges_from(found, cutoffs, datetime_format, strftime, sep)


def _steps(cutoffs: list, datetime_format: str) -> list[dt.datetime]:
    return sorted({_as_date(c, datetime_format) for c in cutoffs})


def date_counts(date_col: str, cutoffs: list, datetime_format: str = "%Y-%m-%d") -> list[Column]:
    """Aggregates that `ranges_from` makes the ranges of: rows between cutoffs and both ends."""
    d = f"cast(`{date_col}` AS timestamp_ntz)"
    steps = _steps(cutoffs, datetime_format)
    place = "0" if not steps else " + ".join(f"int({d} >= {_literal(s)})" for s in steps)
    rows = [F.expr(f"count_if({d} IS NOT NULL AND {place} = {k}) AS _rows{k}") for k in range(len(steps) + 1)]
    return [*rows, F.expr(f"min({d}) AS _low"), F.expr(f"max({d}) AS _high")]


def ranges_from(
    found: Row, cutoffs: list, datetime_format: str = "%Y-%m-%d", strftime: str = "%Y%m%d", sep: str = " ~ "
) -> list[DateRange]:
    """The ranges of `date_ranges` from its counts."""
    low, high = found["_low"], found["_high"]
    if low is None:
        return []
    given = sorted(cutoffs, key=lambda c: _as_date(c, datetime_format))
    dates = [_as_date(c, datetime_format) for c in given]
    steps = _steps(cutoffs, datetime_format)
    counts = {k: found[f"_rows{k}"] for k in range(len(steps) + 1)}

    def rows_between(start: dt.datetime, end: dt.datetime) -> int:
        first = 0 if start <= low else sum(s <= start for s in steps)
        last = len(steps) if end > high else sum(s < end for s in steps)
        return sum(n for place, n in counts.items() if first <= place <= last)

    exact = {d for c, d in zip(given, dates) if isinstance(c, dt.date)}
    bounds = ([] if low in exact else [low]) + dates + ([] if high in exact else [high])
    bounds[-1] += dt.timedelta(days=1)
    ranges, start = [], bounds[0]
    for end in bounds[1:]:
        rows = rows_between(start, end) if start < end else 0
        if rows:
            last_day = end - dt.timedelta(days=1)
            label = f"{start.strftime(strftime)}{sep}{last_day.strftime(strftime)}"
            ranges.append(DateRange(label, start, end, rows))
            start = end
    return ranges


def range_number(date_col: str, ranges: list[DateRange]) -> Column:
    """Number of the range a date lies in from 0, null outside."""
    d = f"cast(`{date_col}` AS timestamp_ntz)"
    tests = [f"WHEN {d} >= {_literal(r.start)} AND {d} < {_literal(r.end)} THEN {i}" for i, r in enumerate(ranges)]
    return F.expr(f"CASE {' '.join(tests)} END" if tests else "int(NULL)")


def range_label(number: Column | str, ranges: list[DateRange]) -> Column:
    """Label of a range number."""
    labels = F.array(*[F.lit(r.label) for r in ranges]) if ranges else F.array().cast("array<string>")
    return F.get(labels, F.col(number) if isinstance(number, str) else number)


def with_date_range(df: DataFrame, date_col: str, ranges: list[DateRange], name: str = "date_range") -> DataFrame:
    """Add the label of the range a date lies in; rows outside get null."""
    return df.withColumn(name, range_label(range_number(date_col, ranges), ranges))


# Reports group by the range number, which shuffles fewer bytes than its label.
RANGE = "_range"


def numbered(df: DataFrame, date_col: str, ranges: list[DateRange]) -> DataFrame:
    """Rows inside the ranges, with the range number."""
    return df.withColumn(RANGE, range_number(date_col, ranges)).where(F.col(RANGE).isNotNull())


def named(df: DataFrame, ranges: list[DateRange]) -> DataFrame:
    """The range number replaced by its label."""
    return df.select(range_label(RANGE, ranges).alias("date_range"), *[c for c in df.columns if c != RANGE])


def filter_dates(df: DataFrame, date_col: str, start, end, datetime_format: str = "%Y-%m-%d") -> DataFrame:
    """Rows with ``start <= date < end``; compared in the type of the column, so that scans can skip."""
    kind = dict(df.dtypes)[date_col]
    c = F.col(f"`{date_col}`")
    low, high = (F.lit(_as_date(v, datetime_format).isoformat(sep=" ")) for v in (start, end))
    if kind == "string":
        return df.where((c.cast("timestamp_ntz") >= low.cast("timestamp_ntz")) & (c.cast("timestamp_ntz") < high.cast("timestamp_ntz")))
    return df.where((c >= low.cast(kind)) & (c < high.cast(kind)))
