"""Tables of other databases over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Default ports and rows per round trip.
DORIS_PORT = 9030
ORACLE_PORT = 1521
INSERT_ROWS = 1024
FETCH_ROWS = 32_768


def doris_url(hostname: str, database: str | None = None, port: int = DORIS_PORT) -> str:
    """URL of a server that speaks the MySQL protocol."""
    return f"jdbc:mysql://{hostname}:{port}/{database or ''}"


def oracle_url(hostname: str, service_name: str | None = None, sid: str | None = None, port: int = ORACLE_PORT) -> str:
    """URL by service name or SID; the SID wins when both are given."""
    if sid is not None:
        return f"jdbc:oracle:thin:@{hostname}:{port}:{sid}"
    if service_name is not None:
        return f"jdbc:oracle:thin:@//{hostname}:{port}/{service_name}"
    raise ValueError("an Oracle URL needs a service name or a SID")


def read_options(
    url: str,
    user: str | None = None,
    password: str | None = None,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, str]:
    """Options of a JDBC read; a partition column with bounds makes it parallel."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    split = (partition_column, bounds, num_partitions)
    if any(s is not None for s in split) and any(s is None for s in split):
        raise ValueError("a parallel read needs partition_column, bounds and num_partitions")
    options = {"url": url, "fetchsize": str(fetch_rows)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column is None:
        options["dbtable" if table else "query"] = table or query.strip().rstrip(";")
        return options
    # Spark splits tables only, so a query becomes a derived table.
    options["dbtable"] = table or f"({query.strip().rstrip(';')}) q"
    options["partitionColumn"] = partition_column
    options["lowerBound"], options["upperBound"] = map(str, bounds)
    options["numPartitions"] = str(num_partitions)
    return options


def bounds_options(options: dict) -> dict:
    """Options of the query for the least and the greatest value of the partition column."""
    source = options.get("table") or f"({options['query'].strip().rstrip(';')}) q"
    column = options["partition_column"]
    kept = {k: v for k, v in options.items() if k not in ("table", "query", "partition_column", "bounds", "num_partitions")}
    return {**kept, "query": f"SELECT min({column}) AS low, max({column}) AS high FROM {source}"}


def read_jdbc(spark: SparkSession, url: str, n_rows: int | None = None, **options) -> DataFrame:
    """Read a table or query; filters and limits are pushed to the database.

    With a partition column and a number of partitions many tasks read; bounds
    that are not given are asked from the database first. Without a partition
    column one task reads everything. `n_rows`: None or negative means all rows, 0 none.
    """
    if options.get("partition_column") is not None and options.get("bounds") is None and options.get("num_partitions"):
        asked = spark.read.format("jdbc").options(**read_options(url, **bounds_options(options))).load().first()
        if asked[0] is None:  # no rows to split
            options = {k: v for k, v in options.items() if k not in ("partition_column", "bounds", "num_partitions")}
        else:
            options = {**options, "bounds": (asked[0], asked[1])}
    df = spark.read.format("jdbc").options(**read_options(url, **options)).load()
    return df if n_rows is None or n_rows < 0 else df.limit(n_rows)


def write_options(
    url: str, table: str, user: str | None = None, password: str | None = None, batch_rows: int = INSERT_ROWS
) -> dict[str, str]:
    """Options of a JDBC write."""
    login = {k: v for k, v in (("user", user), ("password", password)) if v is not None}
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **login}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Insert rows in batches; values are bound by the driver, not pasted into SQL."""
    df.write.format("jdbc").options(**write_options(url, table, **options)).mode(mode).save()
