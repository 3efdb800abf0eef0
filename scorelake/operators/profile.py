"""Profiles of tables: distinct values, nulls, sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import human_size
from ..sources.scratch import settled

# Bytes of one value of the types with a fixed width.
TYPE_WIDTHS = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


#: Values of one bitmap, and bitmaps of one column that are built side by side in one pass.
BITMAP_VALUES, BITMAPS_AT_ONCE = 1 << 15, 8
#: Bitmaps are merged in this many groups before the last merge.
MERGE_GROUPS = 64


def _whole_number(name: str, data_type: T.DataType) -> Column | None:
    """A column of whole numbers, dates, times or booleans as long; none for others."""
    c = _quoted(name)
    if isinstance(data_type, (T.IntegralType, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(data_type, T.DateType):
        return F.unix_date(c).cast("bigint")
    return F.unix_micros(c) if isinstance(data_type, T.TimestampType) else None


def _bucket(value: int) -> int:
    """The number that `bitmap_bucket_number` gives a value."""
    return 1 + (value - 1) // BITMAP_VALUES if value > 0 else -(-value // BITMAP_VALUES)


def _dense_columns(df: DataFrame, columns: list[str]) -> dict[int, range]:
    """Column numbers whose values lie so close that bitmaps of their range take less room than the values, and their buckets."""
    numbers = {i: v for i, c in enumerate(columns) if (v := _whole_number(c, df.schema[c].dataType)) is not None}
    if not numbers:
        return {}
    bounds = df.agg(F.count(F.lit(1)), *[f(v) for v in numbers.values() for f in (F.min, F.max)]).first()
    dense = {}
    for k, i in enumerate(numbers):
        low, high = bounds[1 + 2 * k : 3 + 2 * k]
        buckets = range(0) if low is None else range(_bucket(low), _bucket(high) + 1)
        # A bitmap has a byte for eight values; a value that is shuffled has sixteen bytes and more.
        if len(buckets) <= BITMAPS_AT_ONCE or len(buckets) * BITMAP_VALUES // 8 <= bounds[0]:
            dense[i] = buckets
    return dense


def _by_bitmap(df: DataFrame, columns: list[str], dense: dict[int, range]) -> DataFrame:
    """(i, values, nulls) of dense columns: exact bitmaps of the values present, merged over the tasks."""
    value = {i: _whole_number(columns[i], df.schema[columns[i]].dataType) for i in dense}
    few = {i: b for i, b in dense.items() if len(b) <= BITMAPS_AT_ONCE}
    bit = {i: F.bitmap_bit_position(v) for i, v in value.items()}
    built, merged = [], []
    for i, buckets in few.items():
        built.append(F.count_if(value[i].isNull()).alias(f"n{i}"))
        merged.append(F.sum(f"n{i}").alias(f"n{i}"))
        for k, bucket in enumerate(buckets):
            held = bit[i] if len(buckets) == 1 else F.when(F.bitmap_bucket_number(value[i]) == bucket, bit[i])
            built.append(F.bitmap_construct_agg(held).alias(f"b{i}_{k}"))
            merged.append(F.bitmap_or_agg(f"b{i}_{k}").alias(f"b{i}_{k}"))
    parts = []
    if few:
        if df.rdd.getNumPartitions() <= MERGE_GROUPS:
            wide = df.agg(*built)  # few tasks, so one merge is enough
        else:
            part = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_part")
            wide = df.groupBy(part).agg(*built).agg(*merged)
        rows = []
        for i, buckets in few.items():
            bits = [F.coalesce(F.bitmap_count(f"b{i}_{k}"), F.lit(0)) for k in range(len(buckets))]
            rows.append(F.struct(F.lit(i).alias("i"), sum(bits, F.lit(0).cast("bigint")).alias("values"), F.coalesce(f"n{i}", F.lit(0)).alias("nulls")))
        parts.append(wide.select(F.inline(F.array(*rows))))
    many = [i for i in dense if i not in few]
    if many:
        cells = [F.struct(F.lit(i).alias("i"), F.bitmap_bucket_number(value[i]).alias("bucket"), bit[i].alias("bit")) for i in many]
        bitmaps = df.select(F.inline(F.array(*cells))).groupBy("i", "bucket")
        counted = bitmaps.agg(F.bitmap_count(F.bitmap_construct_agg("bit")).alias("values"), F.count_if(F.col("bit").isNull()).alias("nulls"))
        parts.append(counted.groupBy("i").agg(F.sum("values").alias("values"), F.sum("nulls").alias("nulls")))
    return reduce(DataFrame.union, parts)


def _value_rows(df: DataFrame, columns: list[str], numbers: list[int], measured: bool = False) -> DataFrame:
    """One row ``(i, a, b, d[, bytes])`` per cell of the columns with these numbers.

    The value stands in two longs or a double: whole numbers as they are, text and other types as a digest of 16
    bytes. All columns share one scan and one pair of group-bys on keys of fixed width; Spark's
    own plan for several distinct counts carries every column in every row.
    """
    cells = []
    for i in numbers:
        c, data_type = _quoted(columns[i]), df.schema[columns[i]].dataType
        number, zero = _whole_number(columns[i], data_type), F.lit(0).cast("bigint")
        none = F.lit(None).cast("bigint")
        a, b, d = none, none, F.lit(None).cast("double")
        if number is not None:
            a, b = number, F.when(number.isNotNull(), zero)
        elif _is_float(data_type):
            d = c.cast("double")
        else:
            value = c.cast("string")
            if isinstance(data_type, T.BinaryType):
                value = c
            elif isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
                value = F.to_json(F.struct(c))
            # Two hashes that begin differently.
            a, b = (F.when(c.isNotNull(), F.xxhash64(*first, value)) for first in ([], [F.lit(1)]))
        fields = [a.alias("a"), b.alias("b"), d.alias("d")]
        if measured:
            fields.append(F.when(c.isNotNull(), _value_bytes(c, data_type)).cast("bigint").alias("bytes"))
        cells.append(F.struct(F.lit(i).alias("i"), *fields))
    return df.select(F.inline(F.array(*cells)))


def _distinct_counts(df: DataFrame, columns: list[str], measured: bool = False) -> DataFrame:
    """Per column number: distinct values, nulls, NaN cells and, when measured, the longest value."""
    df = settled(df.select(*map(_quoted, dict.fromkeys(columns))))
    dense = _dense_columns(df, columns)
    others = [i for i in range(len(columns)) if i not in dense]
    parts = []
    if dense:
        widths = F.get(F.array(*[F.lit(TYPE_WIDTHS.get(df.schema[c].dataType.simpleString())).cast("bigint") for c in columns]), F.col("i"))
        longest = [F.when(F.col("values") > 0, widths).alias("bytes")] if measured else []
        parts.append(_by_bitmap(df, columns, dense).select("i", "values", "nulls", F.lit(0).cast("bigint").alias("nans"), *longest))
    if others:
        longest = [F.max("bytes").alias("bytes")] if measured else []
        values = _value_rows(df, columns, others, measured).groupBy("i", "a", "b", "d").agg(F.count(F.lit(1)).alias("n"), *longest)
        # A null counted 0 times gives every column a row, even in an empty table.
        numbers = F.explode(F.array(*map(F.lit, others))).alias("i")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in values.dtypes if c not in ("i", "n")]
        none = df.sparkSession.range(1).select(numbers, F.lit(0).cast("bigint").alias("n"), *nothing)
        counted = values.unionByName(none).groupBy("i").agg(
            F.expr("count_if(a IS NOT NULL OR d IS NOT NULL) AS values"),
            F.expr("coalesce(sum(n) FILTER (WHERE a IS NULL AND d IS NULL), 0) AS nulls"),
            F.expr("coalesce(sum(n) FILTER (WHERE isnan(d)), 0) AS nans"),
            *longest,
        )
        parts.append(counted)
    return reduce(DataFrame.unionByName, parts)


def _named(columns: list[str], number: str = "i") -> Column:
    return F.get(F.array(*map(F.lit, columns)), F.col(number))


def nunique(df: DataFrame, columns: list[str] | None = None, axis: int = 0, approx: bool = False) -> DataFrame:
    """Number of distinct values per column (axis 0) or per row (axis 1).

    Every null and every NaN counts on its own. `approx` uses sketches of fixed
    size, for columns with very many values.
    """
    columns = columns or df.columns
    if axis == 1:
        # The array brings its cells to their common type; only floats can be NaN.
        types = [df.schema[c].dataType for c in columns]
        if any(isinstance(t, (T.StringType, T.BooleanType)) for t in types) and len({t.simpleString() for t in types}) > 1:
            cells = F.array(*[_quoted(c).cast("string") for c in columns])
        else:
            cells = F.array(*map(_quoted, columns))
        floats = any(_is_float(t) for t in types) and not any(isinstance(t, T.StringType) for t in types)
        present = F.filter(cells, lambda v: v.isNotNull() & ~F.isnan(v) if floats else v.isNotNull())
        return df.select(
            "*", (F.size(F.array_distinct(present)) + F.size(cells) - F.size(present)).alias("nunique")
        )
    if not approx:
        # All NaN of a column are one value of the group-by.
        count = "values + nulls + IF(nans > 0, nans - 1, 0) AS nunique"
        return _distinct_counts(df, columns).select(_named(columns).alias("column_name"), F.expr(count))
    parts = []
    for i, c in enumerate(columns):
        value = _quoted(c)
        missing = value.isNull()
        if _is_float(df.schema[c].dataType):
            missing = missing | F.isnan(value)
            value = F.nanvl(value, F.lit(None))
        parts.append((F.approx_count_distinct(value) + F.count_if(missing)).alias(f"n{i}"))
    return _long(df.agg(*parts), columns, {"nunique": "n{i}"})


def _long(wide: DataFrame, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per column from a single row of numbered aggregates."""
    rows = []
    for i, c in enumerate(columns):
        measured = [_quoted(pattern.format(i=i)).alias(name) for name, pattern in fields.items()]
        rows.append(F.struct(F.lit(c).alias("column_name"), *measured))
    return wide.select(F.inline(F.array(*rows)))


def _value_bytes(column: Column, data_type: T.DataType) -> Column:
    name = data_type.simpleString()
    if name in TYPE_WIDTHS:
        return F.lit(TYPE_WIDTHS[name])
    if isinstance(data_type, T.DecimalType):
        return F.lit(8 if data_type.precision <= 18 else 16)
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(data_type, T.ArrayType) and data_type.elementType.simpleString() in TYPE_WIDTHS:
        return F.size(column) * TYPE_WIDTHS[data_type.elementType.simpleString()]
    return F.octet_length(F.to_json(F.struct(column)))


def column_sizes(df: DataFrame, human_readable: bool = True) -> DataFrame:
    """``(column_name, bytes[, size])``, largest first; the bytes of all non-null values, in one scan."""
    parts = []
    for i, f in enumerate(df.schema.fields):
        c = _quoted(f.name)
        size = F.sum(F.when(c.isNotNull(), _value_bytes(c, f.dataType))).cast("bigint")
        parts.append(F.coalesce(size, F.lit(0)).alias(f"b{i}"))
    sizes = _long(df.agg(*parts), df.columns, {"bytes": "b{i}"}).orderBy(F.desc("bytes"), "column_name")
    return sizes.withColumn("size", human_size("bytes")) if human_readable else sizes


def result_size(df: DataFrame) -> DataFrame:
    """One row ``(rows, bytes)``."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        c = _quoted(f.name)
        parts.append(F.coalesce(F.sum(F.when(c.isNotNull(), _value_bytes(c, f.dataType))), F.lit(0)).alias(f"b{i}"))
    total = " + ".join(f"b{i}" for i in range(len(df.columns))) or "0"
    return df.agg(*parts).selectExpr("rows", f"bigint({total}) AS bytes")


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: type, comment, longest value, precision, distinct and null counts, density.

    All columns are measured in one scan. Distinct counts are exact, which
    shuffles the distinct values of every column; `approx` replaces them by
    sketches, and then no values are shuffled. Density is 1 / distinct values.
    Maps, which have no equality, get no approximate count.
    """
    fields, columns = df.schema.fields, df.columns
    if approx:
        parts = []
        for i, f in enumerate(fields):
            c = _quoted(f.name)
            comparable = not any(w in f.dataType.simpleString() for w in ("map<", "variant"))
            longest = F.max(F.when(c.isNotNull(), _value_bytes(c, f.dataType))).cast("bigint")
            parts += [
                (F.approx_count_distinct(c) if comparable else F.lit(None)).cast("bigint").alias(f"d{i}"),
                F.count_if(c.isNull()).alias(f"n{i}"),
                longest.alias(f"l{i}"),
            ]
        measured = {"i": "i{i}", "data_length": "l{i}", "num_distinct": "d{i}", "num_nulls": "n{i}"}
        numbers = [F.lit(i).alias(f"i{i}") for i in range(len(fields))]
        rows = _long(df.agg(*parts).select("*", *numbers), columns, measured)
    else:
        rows = _distinct_counts(df, columns, measured=True).selectExpr(
            "i", "bytes AS data_length", "values AS num_distinct", "nulls AS num_nulls"
        )
    precisions = [f.dataType.precision if isinstance(f.dataType, T.DecimalType) else None for f in fields]
    return rows.select(
        _named(columns).alias("column_name"),
        _named([f.metadata.get("comment") for f in fields]).cast("string").alias("comment"),
        _named([f.dataType.simpleString() for f in fields]).alias("data_type"),
        "data_length",
        _named(precisions).cast("int").alias("data_precision"),
        "num_distinct",
        "num_nulls",
        F.expr("try_divide(1D, num_distinct) AS density"),
    )
