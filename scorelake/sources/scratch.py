"""The shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ending: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A private local folder is made only in local mode with the setting unset;
    on a cluster that would not be shared, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    existing = context.getCheckpointDir()
    if existing:
        return existing
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="scorelake-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; what is written there is deleted when the application ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    if root not in _ending:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        store.deleteOnExit(folder)
        _ending.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


#: Steps of a plan that cost no more than a scan.
CHEAP = {"Project", "Filter", "Relation", "LogicalRelation", "LocalRelation", "LogicalRDD", "Range", "RelationV2", "DataSourceV2ScanRelation", "InMemoryRelation", "Union", "Generate"}


def is_scan(df: DataFrame) -> bool:
    """Whether a frame is read without any shuffle."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    steps = [re.match(r"[\s:+|-]*(\w+)", line) for line in lines]
    return all(s is None or s[1] in CHEAP for s in steps)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A frame that can be scanned many times: itself if it is a plain scan, else written to the shared folder once.

    Give it only the columns that are needed.
    """
    return df if is_scan(df) else written(df, "settled")
