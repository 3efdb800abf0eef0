"""Ordered exports in chunks, with a manifest, that go on where they were stopped."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import rename_columns
from ..operators.prefix import chunk_ids
from .sinks import CSV_READ, CSV_WRITE, MAX_ROWS_PER_FILE

#: Chunks written by one job; what a stopped export has to write again is one job at most.
CHUNKS_PER_JOB = 1000
MANIFEST = "chunk bigint, file string, rows bigint, bytes bigint, checksum string"


def export_ordered(
    df: DataFrame,
    path: str,
    order_by: list[str],
    max_rows: int = MAX_ROWS_PER_FILE,
    format: str = "csv",
    column_names: list[str] | None = None,
    chunks_per_job: int = CHUNKS_PER_JOB,
) -> DataFrame:
    """Write a table in chunks of `max_rows` rows by a given order, one file each, and return the manifest.

    The manifest holds the chunk number (from 0), file, rows, bytes and SHA-256 of every file. Rows are numbered once and
    kept beside the files (``_numbered``) until the export is done, so one that was stopped is called again with the same arguments
    and goes on behind the last job that finished; what a stopped job left is written anew. A chunk is sorted and
    written by one task and many chunks by many tasks. Of an export that is done, calling it again returns the manifest.
    """
    if max_rows < 1 or chunks_per_job < 1:
        raise ValueError("max_rows and chunks_per_job must be positive")
    spark = df.sparkSession
    done = manifest(spark, path)
    if _exists(spark, f"{path}/_DONE"):
        return done
    df = rename_columns(df, column_names)
    chunk = "chunk"
    if chunk in {c.lower() for c in df.columns}:
        raise ValueError("a column is called chunk, as the folders are; rename it by column_names")
    numbered = f"{path}/_numbered"
    if not _exists(spark, f"{numbered}/_SUCCESS"):
        chunk_ids(df, order_by, max_rows, chunk).write.mode("overwrite").parquet(numbered)
    rows = spark.read.schema(_with_chunk(df.schema)).parquet(numbered)
    counts = rows.groupBy(chunk).agg(F.count(F.lit(1)).alias("rows"))
    last = rows.agg(F.max(chunk)).first()[0]
    finished = done.agg(F.max(chunk)).first()[0]
    first = 0 if finished is None else finished + 1
    options = {**CSV_WRITE, "header": "true"} if format == "csv" else {}
    order = [F.col(f"`{c}`").asc_nulls_first() for c in order_by]
    for begin in range(first, 0 if last is None else last + 1, chunks_per_job):
        wave = (F.col(chunk) >= begin) & (F.col(chunk) < begin + chunks_per_job)
        tasks = min(chunks_per_job, last + 1 - begin)
        dealt = rows.where(wave).repartition(tasks, chunk).sortWithinPartitions(chunk, *order)
        # Folders of these chunks only are replaced.
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
        writer.partitionBy(chunk).format(format).save(path)
        folders = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        found = folders.load([f"{path}/{chunk}={c}" for c in range(begin, begin + tasks)])
        files = found.select(
            F.regexp_extract("path", r"/chunk=(\d+)/", 1).cast("bigint").alias(chunk),
            F.regexp_extract("path", r"(chunk=\d+/[^/]+)$", 1).alias("file"),
            F.col("length").alias("bytes"),
            F.sha2("content", 256).alias("checksum"),
        )
        listed = files.join(counts.where(wave), chunk).select(chunk, "file", "rows", "bytes", "checksum")
        listed.coalesce(1).write.mode("append").parquet(f"{path}/_manifest")  # a row per chunk of the job
    _touch(spark, f"{path}/_DONE")
    _delete(spark, numbered)
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of an ordered export that are finished: chunk, file, rows, bytes, checksum. None yet is an empty table."""
    if not _exists(spark, f"{path}/_manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str, schema=None, format: str = "csv") -> DataFrame:
    """The rows of an ordered export with their chunk numbers in a column ``chunk``."""
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, chunk bigint" if isinstance(schema, str) else _with_chunk(schema))
    if format == "csv":
        reader = reader.options(**CSV_READ).option("header", True).option("inferSchema", schema is None)
    return reader.format(format).load(path)


def changed_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, file, problem) of the manifest's files that are missing or differ from it; no rows if all is well."""
    wanted = manifest(spark, path)
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    except AnalysisException:
        return wanted.select("chunk", "file", F.lit("missing").alias("problem"))
    files = found.select(F.regexp_extract("path", r"(chunk=\d+/[^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("now")).where("file != ''")
    both = wanted.join(files, "file", "left")
    problem = F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("checksum"), "changed")
    return both.select("chunk", "file", problem.alias("problem")).where("problem IS NOT NULL")


def _with_chunk(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("chunk", T.LongType())])


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    store, folder = _store(spark, path)
    return store.exists(folder)


def _touch(spark: SparkSession, path: str) -> None:
    store, folder = _store(spark, path)
    if not store.exists(folder):
        store.mkdirs(folder.getParent())
        store.create(folder, True).close()


def _delete(spark: SparkSession, path: str) -> None:
    store, folder = _store(spark, path)
    store.delete(folder, True)
