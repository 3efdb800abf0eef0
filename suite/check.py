"""Compare every query with its SQL on the same tables: ``python -m suite.check [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES, TABLES


def normal(value):
    """A cell in a form both engines share."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


# The type names of both engines.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def types_of(df, relation) -> str:
    """Columns whose types differ."""
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    pairs = [(n, TYPES.get(t, t.upper()), theirs.get(n)) for n, t in df.dtypes]
    return str([p for p in pairs if p[1] != p[2]]) if any(p[1] != p[2] for p in pairs) else ""


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Empty when the results are equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.sql(ORACLE[name])
    theirs = rows_of(result.columns, result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if types_of(df, result):
        return f"types {types_of(df, result)}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y]
            return f"cells {str(cells)[:600]}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        started = time.time()
        if name not in ORACLE:
            print(f"{name}: no SQL")
            continue
        try:
            difference = compare(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{'DIFFERS' if difference else 'ok':8s}{name} {time.time() - started:.1f}s {difference}", flush=True)
    print(f"{failed} of {len(sys.argv[2:] or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
