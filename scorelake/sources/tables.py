"""Reading tables and files."""

from __future__ import annotations

import csv
import io
import itertools
import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crypto import decrypt_columns
from ..operators.columns import rename_columns, select_columns
from .sinks import CSV_READ, MAX_ROWS_PER_FILE, export_chunked
from .statements import run_all, session_with

ROWS_PER_BATCH = 32_768
#: Lines of a file in which its header row is looked for, beyond the number of the row.
HEADER_LINES = 1000
BLOCK_BYTES = 25 * 1024 * 1024
FORMATS = {"csv": "csv", "json": "json", "parquet": "parquet", "orc": "orc", "txt": "text", "text": "text"}


def read_table(
    spark: SparkSession,
    table: str | DataFrame,
    columns: list[str] | None = None,
    column_names: list[str] | None = None,
    decrypt: list[str] | None = None,
    key: str | Column | None = None,
    limit: int | None = None,
    path: str | None = None,
    format: str = "csv",
    max_rows: int = MAX_ROWS_PER_FILE,
) -> DataFrame:
    """A table with a choice of columns, new names and columns decrypted.

    Columns to decrypt are added to the chosen ones. With a path the result is
    also written there in the given format, in files of at most `max_rows` rows.
    """
    df = table if isinstance(table, DataFrame) else spark.table(table)
    df = select_columns(df, columns, decrypt)
    if decrypt:
        if key is None:
            raise ValueError("a key is needed to decrypt columns")
        df = decrypt_columns(df, decrypt, key)
    df = rename_columns(df, column_names)
    if limit is not None and limit >= 0:
        df = df.limit(limit)
    if path:
        export_chunked(df, path, max_rows, format)
    return df


def read_tables(
    spark: SparkSession,
    tables: list[str | DataFrame],
    columns: list | None = None,
    column_names: list | None = None,
    decrypt: list | None = None,
    paths: list | None = None,
    key: str | Column | None = None,
    n_jobs: int = 10,
    format: str = "csv",
    max_rows: int = MAX_ROWS_PER_FILE,
) -> list:
    """Read, and with paths write, many tables at once; options are one list entry per table.

    Files are written as `read_table` does. Results keep their order; an error takes the place of its table.
    """
    options = [columns, column_names, decrypt, paths]
    for given in options:
        if given is not None and len(given) != len(tables):
            raise ValueError("options must have one entry per table")
    per_table = [[None] * len(tables) if o is None else o for o in options]

    def task(table, cols, names, secret, path):
        return lambda: read_table(spark, table, cols, names, secret, key, None, path, format, max_rows)

    return run_all([task(t, *rest) for t, *rest in zip(tables, *per_table)], n_jobs, True, spark)


def table_sizes(spark: SparkSession, tables: dict[str, DataFrame] | list[str]) -> DataFrame:
    """``(table, rows)`` of several tables, counted in one job."""
    frames = tables if isinstance(tables, dict) else {t: spark.table(t) for t in tables}
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def load_file(
    spark: SparkSession,
    path: str | list[str],
    format: str | None = None,
    schema: T.StructType | str | None = None,
    header: bool | int = True,
    **options,
) -> DataFrame:
    """Read files by suffix: csv, json, parquet, orc or text.

    A csv without schema is read twice, once to infer its types; pass a schema
    for large files. Cells of a csv may span lines, so a task reads whole files.
    `header` may be the row of the header, from 0: the rows before it are
    skipped in every file, and types are inferred below it as for row 0.
    """
    first = path if isinstance(path, str) else path[0]
    suffix = (format or os.path.basename(first.rstrip("/")).rpartition(".")[2]).lower()
    if suffix not in FORMATS:
        raise ValueError(f"format not supported: {suffix!r}")
    if FORMATS[suffix] == "csv" and not isinstance(header, bool) and header > 0:
        return _csv_below(spark, path, header, schema, options)
    reader = spark.read.options(**({**CSV_READ, **options} if FORMATS[suffix] == "csv" else options))
    if schema is not None:
        reader = reader.schema(schema)
    if FORMATS[suffix] == "csv":
        reader = reader.option("header", bool(header) or header == 0).option("inferSchema", schema is None)
    return reader.format(FORMATS[suffix]).load(path)


def _csv_below(spark, path, header_row, schema, options) -> DataFrame:
    """Csv rows below the given header row of each file, with cells that may span lines.

    The files are parsed whole and without a header, all cells as text. A task
    reads files one after the other, so a row's place in its file is counted
    from the first row of the file in the task.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    head = _header(spark, path, header_row, options)
    width = max(len(head), len(schema.fields) if schema is not None else 0)
    cells = [f"_c{i}" for i in range(width)]
    text = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    rows = spark.read.options(**{**CSV_READ, **options}).schema(text).csv(path, header=False)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    first = placed.groupBy("_file").agg(F.min("_at").alias("_first"))
    placed = placed.join(first, "_file").withColumn("_row", F.col("_at") - F.col("_first"))
    below = placed.where(F.col("_row") > header_row)
    if schema is None:
        return _typed(below.select(*[F.col(c).alias(n) for c, n in zip(cells, head) if n]))
    return below.select(*[F.col(c).try_cast(f.dataType).alias(f.name) for c, f in zip(cells, schema.fields)])


def _header(spark, path, header_row, options) -> list[str]:
    """The names in the header row of the first file; empty lines are no rows."""
    given = {k.lower(): v for k, v in options.items()}
    coding = given.get("encoding", given.get("charset", "utf-8"))
    first = min(spark.read.text(path).inputFiles())
    # The bytes of the lines, which are decoded here: the text source knows UTF-8 only.
    head = spark.read.text(first).select(F.col("value").cast("binary").alias("line")).limit(header_row + HEADER_LINES)
    lines = [bytes(r["line"]).decode(coding) for r in head.collect()]
    rows = csv.reader(io.StringIO("\n".join(lines)), delimiter=options.get("sep", options.get("delimiter", ",")))
    names = next(itertools.islice((r for r in rows if r), header_row, None), None)
    if names is None:
        raise ValueError(f"no row {header_row} for a header in {first}")
    return [n.strip() for n in names]


def _typed(df: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that every value has: int, bigint, double, boolean, timestamp or text."""
    kinds = ["int", "bigint", "double", "boolean", "timestamp_ntz"]
    fits = []
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        fits.append(F.count(c).alias(f"n{i}"))
        fits += [F.count(c.try_cast(kind)).alias(f"{kind}{i}") for kind in kinds]
    found = df.agg(*fits).first()
    out = []
    for i, name in enumerate(df.columns):
        kind = next((k for k in kinds if found[f"n{i}"] and found[f"{k}{i}"] == found[f"n{i}"]), "string")
        kind = "timestamp" if kind == "timestamp_ntz" and df.sparkSession.conf.get("spark.sql.timestampType") == "TIMESTAMP_LTZ" else kind
        out.append(F.col(f"`{name}`").try_cast(kind).alias(name))
    return df.select(*out)


def load(spark: SparkSession, data, **options) -> DataFrame:
    """A frame from a Spark frame, a pandas frame or series, or files."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, pd.Series):
        data = data.to_frame()
    if isinstance(data, pd.DataFrame):
        return spark.createDataFrame(data)
    if isinstance(data, (str, list)) and data:
        return load_file(spark, data, **options)
    raise ValueError("data should be a frame or a path")


def iter_batches(df: DataFrame, batch_rows: int = ROWS_PER_BATCH) -> Iterator[list[Row]]:
    """Walk a result page by page on the client.

    One partition at a time comes to the driver, the next one being fetched
    meanwhile. For results a client wants to read; export tables instead.
    """
    if batch_rows < 1:
        raise ValueError("batch size must be positive")
    page: list[Row] = []
    for row in df.toLocalIterator(prefetchPartitions=True):
        page.append(row)
        if len(page) == batch_rows:
            yield page
            page = []
    if page:
        yield page


def read_text_blocks(spark: SparkSession, path: str | list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Lines of text files with the block they start in: ``(file, block, value)``.

    Blocks are the input splits, of `block_bytes` each and numbered from 1; the
    last block of a file is -1. Every task reads one block and nothing is
    shuffled. Only formats that can be split have several blocks.
    """
    session = session_with(
        spark,
        {
            "spark.sql.files.maxPartitionBytes": str(block_bytes),
            "spark.sql.files.minPartitionNum": "1",
            "spark.sql.files.openCostInBytes": "0",
        },
    )
    meta = F.col("_metadata")
    start, length = meta["file_block_start"], meta["file_block_length"]
    last = start + length >= meta["file_size"]
    number = F.floor(start / F.lit(block_bytes)) + 1
    return session.read.text(path).select(
        meta["file_path"].alias("file"), F.when(last, -1).otherwise(number).cast("bigint").alias("block"), "value"
    )
