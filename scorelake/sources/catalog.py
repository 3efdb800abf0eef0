"""What the catalog knows about tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import join_on
from ..operators.profile import column_profile


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def list_schemas(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    """Names of tables and views."""
    return [t.name for t in spark.catalog.listTables(schema)]


def list_views(spark: SparkSession, schema: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(schema) if t.tableType in ("VIEW", "TEMPORARY")]


def list_columns(spark: SparkSession, table: str) -> DataFrame:
    """``(column_name, comment, data_type, nullable)`` of a table."""
    rows = [(c.name, c.description, c.dataType, c.nullable) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "column_name string, comment string, data_type string, nullable boolean")


def show_create(spark: SparkSession, table: str) -> str:
    return spark.sql("SHOW CREATE TABLE IDENTIFIER(:t)", args={"t": table}).first()[0]


def table_detail(spark: SparkSession, table: str) -> dict:
    """Everything the catalog holds about a table."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def describe_table(spark: SparkSession, table: str, approx: bool = False) -> DataFrame:
    """The column dictionary: comments from the catalog joined with measured statistics.

    The name is matched regardless of case.
    """
    declared = list_columns(spark, table).select(
        F.lit(table.rpartition(".")[2].upper()).alias("table_name"), "column_name", F.col("comment").alias("comments")
    )
    measured = column_profile(spark.table(table), approx).drop("comment")
    measured = measured.withColumn("table_name", F.lit(table.rpartition(".")[2].upper()))
    return join_on(declared, measured, ["table_name", "column_name"]).drop("table_name")
