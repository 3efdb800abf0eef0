"""Column expressions shared by the statistics operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units in steps of 1024.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den``, null when the denominator is 0."""
    return F.try_divide(col(num), col(den))


def round_even(x: Column | str, digits: int) -> Column:
    """Round half to even, as numpy and pandas do."""
    return F.bround(col(x), digits)


def clean_number(x: Column | str) -> Column:
    """As double, with NaN turned into null."""
    return F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))


def numeric_label(y: Column, data_type: str) -> Column:
    """A label that can be summed: booleans become 0/1."""
    return y.cast("int") if data_type == "boolean" else y


def binarize(x: Column | str, label) -> Column:
    """1 where the value is the given class, else 0; null stays null."""
    return (col(x) == F.lit(label)).cast("int")


def predict(score: Column | str, threshold: float) -> Column:
    """1 where the score is strictly above the threshold."""
    return (col(score) > F.lit(threshold)).cast("int")


def guarded_log(x: Column) -> Column:
    """Natural log, null for values that have none."""
    return F.when(x > 0, F.log(x))


def psi(expected: Column | str, actual: Column | str) -> Column:
    """Population stability term of one bin, null when a ratio is 0 or undefined."""
    expected, actual = col(expected), col(actual)
    return (actual - expected) * guarded_log(safe_div(actual, expected))


def human_size(size: Column | str, digits: int = 2) -> Column:
    """Bytes as text in 1024 steps, such as ``1.50 KiB``."""
    size = col(size).cast("double")
    text = None
    for power, unit in enumerate(SIZE_UNITS):
        shown = F.format_string(f"%.{digits}f {unit}", round_even(size / F.lit(1024.0**power), digits))
        if unit == SIZE_UNITS[-1]:
            return text.otherwise(shown)
        fits = size < F.lit(1024.0 ** (power + 1))
        text = F.when(size.isNull(), None).when(fits, shown) if text is None else text.when(fits, shown)


def extract_id(text: Column | str, pattern: str, group: int = 1) -> Column:
    """The given group of a pattern; text that does not match is returned as it is."""
    text = col(text)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group)).otherwise(text)
