import duckdb
import pytest

from scorelake.llm.queries import ORACLE, QUERIES


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    d = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, d)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{d}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())
