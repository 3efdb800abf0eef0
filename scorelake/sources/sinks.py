"""Writing tables and files."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crypto import encrypt_columns
from ..operators.columns import rename_columns, select_columns

MAX_ROWS_PER_FILE = 100_000
#: What every csv is written with: a null is an empty cell, an empty text is ``""``, quotes
#: are doubled, spaces stay, and times keep their microseconds.
CSV_WRITE = {
    "nullValue": "",
    "emptyValue": '""',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: And read with: cells may span lines. An empty cell is read as the null mark, which no text
#: should be equal to, so that ``""`` stays an empty text. Times are parsed in any usual form.
CSV_READ = {
    "multiLine": "true",
    "escape": '"',
    "nullValue": "\x00null\x00",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(
    df: DataFrame,
    path: str,
    column_names: list[str] | None = None,
    encoding: str = "UTF-8",
    header: bool = True,
    mode: str = "error",
    **options,
) -> str:
    """Write a csv directory, one file per task, each with a header."""
    named = rename_columns(df, column_names)
    named.write.options(**{**CSV_WRITE, **options}).mode(mode).csv(path, header=header, encoding=encoding)
    return path


def append_csv(df: DataFrame, path: str, **options) -> str:
    """Add rows to a csv directory, made if missing. Readers drop the header of every file."""
    return write_csv(df, path, mode="append", **options)


def export_chunked(
    df: DataFrame,
    path: str,
    max_rows: int = MAX_ROWS_PER_FILE,
    format: str = "csv",
    mode: str = "overwrite",
    column_names: list[str] | None = None,
    partition_by: str | None = None,
) -> str:
    """Write a table in files of at most `max_rows` rows, in one scan and without a shuffle.

    Every task splits its own output. `partition_by`, such as a column from
    `chunk_ids`, writes one folder per value instead of one insert per chunk.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    writer = rename_columns(df, column_names).write.mode(mode).option("maxRecordsPerFile", max_rows)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if format == "csv":
        writer = writer.options(**CSV_WRITE).option("header", True)
    writer.format(format).save(path)
    return path


def read_chunks(spark: SparkSession, path: str, format: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    """All files of an export as one table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if format == "csv":
        reader = reader.options(**CSV_READ).option("header", True).option("inferSchema", schema is None)
    return reader.format(format).load(path)


def save_table(
    df: DataFrame,
    table: str | None = None,
    if_exists: str = "raise",
    columns: list[str] | None = None,
    column_names: list[str] | None = None,
    encrypt: list[str] | None = None,
    key: str | Column | None = None,
    format: str = "parquet",
    path: str | None = None,
    keep_old: bool = False,
) -> str:
    """Save as a table and return its name; managed, or at `path` when given.

    Without a name one is made up. If the table exists: ``raise`` an error,
    ``silent`` keeps the data under a made-up name, ``replace`` publishes a new version:
    the rows are written to a folder of their own beside the old ones, and only then is the table pointed
    to them (``<location>-versions/…``, also with `path`). Until that moment, and for good if the write fails, readers see the old rows,
    which the new ones may be made from. The folder of the version before is deleted after the
    switch, unless `keep_old`, for readers that are still in the middle of it.
    """
    if if_exists not in ("raise", "silent", "replace"):
        raise ValueError("if_exists only accepts 'raise', 'silent' or 'replace'")
    df = prepared(df, columns, column_names, encrypt, key)
    spark = df.sparkSession
    exists = table is not None and spark.catalog.tableExists(table)
    if table is None or (if_exists == "silent" and exists):
        table, exists = f"upload_{uuid4().hex[:12]}", False
    if if_exists == "replace" and exists:
        _publish(df, table, format, path, keep_old)
        return table
    writer = df.write.format(format).mode("error")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Location'")
    return rows.first()["data_type"]


def _publish(df: DataFrame, table: str, format: str, path: str | None, keep_old: bool) -> None:
    """Write a version of an existing table, then switch the table to it."""
    spark = df.sparkSession
    old = _location(spark, table)
    # Versions stand beside the first location, so that no reader of it meets their files.
    root = re.sub(r"-versions/[0-9a-f]{32}$", "", (path or old).rstrip("/"))
    new = f"{root}-versions/{uuid4().hex}"
    trial = f"{table}_{uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    store = lambda p: hadoop(p).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.format(format).mode("error").option("path", new).saveAsTable(trial)
    except BaseException:
        drop_table(spark, trial)
        store(new).delete(hadoop(new), True)
        raise
    drop_table(spark, trial)  # its files stay: the table of a path is external
    if spark.table(table).dtypes == df.dtypes and _provider(spark, table) == format.lower():
        # One change in the catalog.
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{_quoted(new)}'", args={"t": table})
    else:
        # Other columns or files: the new table is made under another name, so that only names change.
        spark.catalog.createTable(trial, path=new, source=format)
        aside = f"{table}_{uuid4().hex[:12]}"
        rename_table(spark, table, aside)
        try:
            rename_table(spark, trial, table)
        except BaseException:
            rename_table(spark, aside, table)
            raise
        old = _location(spark, aside)
        drop_table(spark, aside)
    spark.catalog.refreshTable(table)
    if not keep_old:
        store(old).delete(hadoop(old), True)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _provider(spark: SparkSession, table: str) -> str:
    return spark.sql("DESCRIBE FORMATTED IDENTIFIER(:t)", args={"t": table}).where("col_name = 'Provider'").first()["data_type"].lower()


def insert_rows(
    df: DataFrame,
    table: str,
    columns: list[str] | None = None,
    column_names: list[str] | None = None,
    encrypt: list[str] | None = None,
    key: str | Column | None = None,
) -> str:
    """Add rows to a table by column position; the table is made if missing."""
    df = prepared(df, columns, column_names, encrypt, key)
    if df.sparkSession.catalog.tableExists(table):
        df.write.insertInto(table)
    else:
        df.write.saveAsTable(table)
    return table


def prepared(df, columns, column_names, encrypt, key) -> DataFrame:
    """Chosen columns, encrypted where asked, under their new names."""
    df = select_columns(df, columns)
    if encrypt:
        if key is None:
            raise ValueError("a key is needed to encrypt columns")
        df = encrypt_columns(df, encrypt, key)
    return rename_columns(df, column_names)


def split_table(df: DataFrame, path: str, conditions: dict[str, Column | str], format: str = "parquet") -> dict[str, str]:
    """Write the rows that meet each condition to their own folder, reading the table once.

    A row that meets several conditions goes to each of them. Folders are numbered
    in the order of the conditions, so names may hold any character and columns any name;
    a condition that no row meets has an empty table of the same columns.
    """
    spark, taken = df.sparkSession, {c.lower() for c in df.columns}
    route = next(name for i in range(len(taken) + 1) if (name := f"_part{i}") not in taken)
    met = F.array_compact(
        F.array(*[F.when(F.expr(c) if isinstance(c, str) else c, F.lit(i)) for i, c in enumerate(conditions.values())])
    )
    routed = df.withColumn(route, F.explode(met))
    options = {**CSV_WRITE, "header": "true"} if format == "csv" else {}
    routed.write.options(**options).mode("overwrite").partitionBy(route).format(format).save(path)
    paths = {name: f"{path}/{route}={i}" for i, name in enumerate(conditions)}
    for folder in paths.values():
        try:
            spark.read.schema(df.schema).format(format).load(folder)
        except AnalysisException:  # no row met the condition, so there is no folder
            df.limit(0).write.options(**options).format(format).save(folder)
    return paths


def create_like(spark: SparkSession, table: str, like: str) -> None:
    """An empty table with the columns of another."""
    spark.sql("CREATE TABLE IDENTIFIER(:t) LIKE IDENTIFIER(:l)", args={"t": table, "l": like})


def rename_table(spark: SparkSession, table: str, name: str) -> None:
    spark.sql("ALTER TABLE IDENTIFIER(:t) RENAME TO IDENTIFIER(:n)", args={"t": table, "n": name})


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it exists."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
