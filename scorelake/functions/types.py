"""Type names, casts and type shrinking."""

from __future__ import annotations

import logging
import re

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import clean_number

log = logging.getLogger(__name__)

# Accepted type names and the Spark type each one stands for.
TYPE_NAMES = {
    "boolean": "boolean",
    "tinyint": "tinyint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "largeint": "decimal(38,0)",
    "float": "float",
    "double": "double",
    "decimal": "decimal",
    "decimalv3": "decimal",
    "varchar": "string",
    "char": "string",
    "text": "string",
    "string": "string",
    "json": "variant",
    "jsonb": "variant",
    "date": "date",
    "datev2": "date",
    "datetime": "timestamp_ntz",
    "datetimev2": "timestamp_ntz",
    "timestamp": "timestamp",
    "time": "string",
    "array": "array",
    "map": "map",
    "struct": "struct",
    "hll": "binary",
    "quantile_state": "binary",
    "bitmap": "binary",
    "agg_state": "binary",
}
KEEPS_OPTIONS = ("decimal", "decimalv3")


def parse_type(name: str) -> T.DataType:
    """A type name to a Spark type, `NullType` with a warning when unknown.

    ``decimal(p,s)`` and the element types of arrays, maps and structs are kept.
    """
    text = name.strip().lower()

    def spark_name(match: re.Match) -> str:
        word, options = match.group(1), match.group(2) or ""
        if word not in TYPE_NAMES:
            raise KeyError(word)
        return TYPE_NAMES[word] + (options if word in KEEPS_OPTIONS else "")

    try:
        # A word followed by ":" is the name of a struct field, not a type.
        return T.DataType.fromDDL(re.sub(r"\b([a-z]\w*)\b(?!\s*:)\s*(\([^)]*\))?", spark_name, text))
    except (KeyError, ParseException):
        log.warning("type name not recognised: %r", name)
        return T.NullType()


def cast_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to named types; values that do not fit become null.

    Columns whose type name is unknown keep their type.
    """
    casts = {}
    for name, type_name in types.items():
        target = parse_type(type_name)
        if isinstance(target, T.VariantType):
            casts[name] = F.try_parse_json(F.col(f"`{name}`"))
        elif not isinstance(target, T.NullType):
            casts[name] = F.col(f"`{name}`").try_cast(target)
    return df.withColumns(casts)


# The signed integer types, narrowest first, with their bits.
INTEGER_BITS = [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)]
FLOAT_MAX = 3.4028234663852886e38


def shrink_types(df: DataFrame, floats: bool = False) -> DataFrame:
    """Narrow numeric columns to the smallest type holding their values.

    One scan finds the minimum and maximum of every numeric column. Bounds are
    strict: a column that holds 127 does not fit a byte. Doubles lose digits as
    floats, so they are narrowed only with ``floats=True``.
    """
    numeric = [
        f
        for f in df.schema.fields
        if isinstance(f.dataType, T.IntegralType)
        or (floats and isinstance(f.dataType, T.DoubleType))
    ]
    if not numeric:
        return df
    values = [
        clean_number(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in numeric
    ]
    bounds = df.agg(
        *[F.min(v).alias(f"lo{i}") for i, v in enumerate(values)],
        *[F.max(v).alias(f"hi{i}") for i, v in enumerate(values)],
    ).first()
    casts = {}
    for i, f in enumerate(numeric):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is None or hi is None:
            continue
        if isinstance(f.dataType, T.DoubleType):
            if -FLOAT_MAX < lo and hi < FLOAT_MAX:
                casts[f.name] = F.col(f"`{f.name}`").cast("float")
            continue
        fitting = (t for t, bits in INTEGER_BITS if -(2 ** (bits - 1)) < lo and hi < 2 ** (bits - 1) - 1)
        target = next(fitting, None)
        if target:
            casts[f.name] = F.col(f"`{f.name}`").cast(target)
    return df.withColumns(casts) if casts else df


def normalize_decimals(df: DataFrame) -> DataFrame:
    """Decimal columns as long when every value is whole and fits, else as double."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    if not decimals:
        return df

    def is_whole(c):
        return F.coalesce(c == c.try_cast("bigint"), c.isNull())

    whole = df.agg(
        *[F.bool_and(is_whole(F.col(f"`{c}`"))).alias(f"w{i}") for i, c in enumerate(decimals)]
    ).first()
    return df.withColumns(
        {
            c: F.col(f"`{c}`").cast("double" if whole[f"w{i}"] is False else "bigint")
            for i, c in enumerate(decimals)
        }
    )
