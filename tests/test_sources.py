import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

import scorelake as sl
from scorelake.sources.jdbc import read_options, write_options

KEY = "0123456789abcdef"


@pytest.fixture(scope="module")
def items(spark):
    return spark.range(1000).selectExpr("id", "concat('n', id) AS name", "id / 2 AS half")


@pytest.fixture(autouse=True)
def no_tables(spark):
    yield
    for t in spark.catalog.listTables():
        if t.tableType == "TEMPORARY":
            spark.catalog.dropTempView(t.name)
        else:
            sl.drop_table(spark, t.name)


def test_csv_round_trip(spark, items, tmp_path):
    path = str(tmp_path / "a.csv")
    sl.append_csv(items.where("id < 10"), path, column_names=["a", "b", "c"])
    sl.append_csv(items.where("id >= 10"), path, column_names=["a", "b", "c"])
    got = sl.load(spark, path)
    assert got.dtypes == [("a", "int"), ("b", "string"), ("c", "double")] and got.count() == 1000
    assert got.where("a = 7").first()["c"] == 3.5
    with pytest.raises(Exception, match="(?i)already exists"):
        sl.write_csv(items, path)


@pytest.mark.parametrize("format", ["json", "parquet", "orc", "csv"])
def test_load_by_suffix(spark, items, tmp_path, format):
    path = str(tmp_path / f"data.{format}")
    writer = items.write.option("header", True)
    writer.format(format).save(path)
    assert sl.load(spark, path).agg(F.sum("id")).first()[0] == 499500


def test_csv_with_header_further_down(spark, tmp_path):
    (tmp_path / "a.csv").write_text("made by x\nid,name\n1,a\n2,b\n")
    (tmp_path / "b.csv").write_text("made by y\nid,name\n3,\"c,d\"\n")
    got = sl.load_file(spark, str(tmp_path), "csv", header=1)
    assert got.dtypes == [("id", "int"), ("name", "string")]
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b"), (3, "c,d")]
    typed = sl.load_file(spark, str(tmp_path), "csv", "k int, v string", header=1)
    assert sorted(r["k"] for r in typed.collect()) == [1, 2, 3]
    assert sl.load_file(spark, str(tmp_path / "a.csv"), header=0).columns == ["made by x"]


def test_header_row_with_cells_over_lines(spark, tmp_path):
    rows = 'a title\n\nof two rows\nid,name,day,x,ok,big\n1,"two\nlines",2024-01-02 03:04:05.000006,1.5,true,1\n2,"say ""so""",2024-01-03 00:00:00,2,false,9007199254740993\n'
    (tmp_path / "a.csv").write_text(rows)
    got = sl.load_file(spark, str(tmp_path / "a.csv"), header=2)
    assert [t for _, t in got.dtypes] == ["int", "string", "timestamp", "double", "boolean", "bigint"]
    assert [tuple(r)[:2] for r in got.orderBy("id").collect()] == [(1, "two\nlines"), (2, 'say "so"')]
    assert got.orderBy("id").first()["day"].microsecond == 6 and got.agg(F.max("big")).first()[0] == 9007199254740993
    (tmp_path / "b.csv").write_bytes("Über\nn\u00e4me;k\né;1\n".encode("latin-1"))
    other = sl.load_file(spark, str(tmp_path / "b.csv"), header=1, encoding="ISO-8859-1", sep=";")
    assert other.columns == ["näme", "k"] and tuple(other.first()) == ("é", 1)
    with pytest.raises(ValueError):
        sl.load_file(spark, str(tmp_path / "b.csv"), header=9)


def test_csv_keeps_every_cell(spark, tmp_path):
    import datetime as dt

    texts = ["a\nb", "c\r\nd", "e\rf", 'say "so"', "back\\slash", "\\", '\\"', " spaces ", "", None, ",", '"', "\t", "é\U0001f600", "null", "\\N", "#"]
    when = dt.datetime(2024, 3, 31, 1, 30, 0, 123456)
    df = spark.createDataFrame([(i, t, when, when.date(), 1.1 * i) for i, t in enumerate(texts)], "id long, t string, at timestamp, d date, x double")
    df = df.withColumn("ntz", F.col("at").cast("timestamp_ntz"))
    path = sl.export_chunked(df, str(tmp_path / "x"), max_rows=4)
    back = sl.read_chunks(spark, path, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    sl.write_csv(df, str(tmp_path / "y"))
    sl.append_csv(df.limit(0), str(tmp_path / "y"))
    back = sl.load_file(spark, str(tmp_path / "y"), "csv", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_read_table_writes_as_asked(spark, items, tmp_path):
    sl.read_table(spark, items, path=str(tmp_path / "p"), format="parquet", max_rows=300)
    assert spark.read.parquet(str(tmp_path / "p")).count() == items.count()
    results = sl.read_tables(spark, [items, items], paths=[str(tmp_path / "a"), str(tmp_path / "b")], format="json", max_rows=100)
    assert not any(isinstance(r, Exception) for r in results) and spark.read.json(str(tmp_path / "a")).count() == items.count()


def test_load_other_kinds(spark, items, tmp_path):
    (tmp_path / "t.txt").write_text("x\ny\n")
    assert sl.load(spark, str(tmp_path / "t.txt")).count() == 2
    assert sl.load(spark, items) is items
    assert sl.load(spark, pd.DataFrame({"a": [1, 2]})).count() == 2
    assert sl.load(spark, pd.Series([1, 2], name="s")).columns == ["s"]
    for bad in ("x.xlsx", 5, None):
        with pytest.raises(ValueError):
            sl.load(spark, bad)


def test_export_is_cut_in_files(spark, items, tmp_path):
    path = sl.export_chunked(items.coalesce(2), str(tmp_path / "out"), max_rows=150, column_names=["i", "n", "h"])
    files = glob.glob(f"{path}/*.csv")
    assert len(files) == 8 and all(sum(1 for _ in open(f)) <= 151 for f in files)
    assert sl.read_chunks(spark, path).count() == 1000
    with pytest.raises(ValueError):
        sl.export_chunked(items, path, max_rows=0)


def test_split_table(spark, items, tmp_path):
    paths = sl.split_table(items, str(tmp_path / "s"), {"low": "id < 600", "even": F.col("id") % 2 == 0, "none": "false"})
    assert spark.read.parquet(paths["low"]).count() == 600 and spark.read.parquet(paths["even"]).count() == 500
    none = spark.read.parquet(paths["none"])
    assert none.columns == items.columns and none.count() == 0
    odd = items.withColumn("part", F.lit("kept")).withColumn("_part0", F.lit(1))
    paths = sl.split_table(odd, str(tmp_path / "odd"), {"a=b": "id < 3", "x/y": "id >= 998", "": "false", "é *": "id = 5"})
    counts = {name: spark.read.parquet(p).where("part = 'kept'").count() for name, p in paths.items()}
    assert counts == {"a=b": spark.read.parquet(paths["a=b"]).count(), "x/y": odd.where("id >= 998").count(), "": 0, "é *": 1}
    assert counts["a=b"] == odd.where("id < 3").count() and spark.read.parquet(paths["a=b"]).columns == odd.columns


def test_a_script_stops_at_its_first_error(spark):
    script = "CREATE TABLE made_by_script USING parquet AS SELECT 1 AS a; SELECT missing; INSERT INTO made_by_script VALUES (2)"
    results = sl.run_sql_script(spark, script)
    assert len(results) == 2 and isinstance(results[1], Exception)
    assert spark.table("made_by_script").count() == 1
    together = sl.run_sql_script(spark, "SELECT 1; SELECT missing; SELECT 3", concurrent=True)
    assert [isinstance(r, Exception) for r in together] == [False, True, False]
    future = sl.run_sql_script(spark, "SELECT 1 AS a", sync=False)[0]
    assert future.result()[0].first()["a"] == 1
    sl.drop_table(spark, "made_by_script")


def test_a_table_replaces_itself(spark, items, tmp_path):
    for path in (None, str(tmp_path / "t")):
        sl.save_table(items, "self", path=path)
        sl.save_table(spark.table("self").where("id < 10"), "self", if_exists="replace", path=path)
        assert spark.table("self").count() == items.where("id < 10").count()
        sl.drop_table(spark, "self")
        if path is None:
            assert not [t for t in sl.list_tables(spark) if "self" in str(t)]


def test_a_failed_replace_leaves_the_old_rows(spark, items, tmp_path):
    for path in (None, str(tmp_path / "kept")):
        sl.save_table(items, "kept", path=path)
        before = sorted(map(tuple, spark.table("kept").collect()))
        tables = len(sl.list_tables(spark))
        stops = items.withColumn("name", F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("name")))
        for broken in (stops, stops.withColumn("more", F.lit(1))):
            with pytest.raises(Exception, match="stop"):
                sl.save_table(broken, "kept", if_exists="replace", path=path)
            spark.catalog.refreshTable("kept")
            assert sorted(map(tuple, spark.table("kept").collect())) == before and len(sl.list_tables(spark)) == tables
        sl.drop_table(spark, "kept")


def test_versions_follow_each_other(spark, items):
    sl.save_table(items, "versions")
    old = spark.table("versions").inputFiles()
    for k in (5, 3):
        sl.save_table(spark.table("versions").where(f"id < {k}"), "versions", if_exists="replace", keep_old=k == 5)
        assert sorted(r["id"] for r in spark.table("versions").collect()) == list(range(k))
    # The first version was kept for its readers, the second was not.
    assert spark.read.parquet(*old).count() == items.count()
    sl.insert_rows(items.where("id = 9"), "versions")
    assert spark.table("versions").count() == 4
    sl.save_table(items.selectExpr("id AS other"), "versions", if_exists="replace")
    assert spark.table("versions").columns == ["other"] and spark.table("versions").count() == items.count()
    sl.drop_table(spark, "versions")


def test_ordered_exports(spark, tmp_path, monkeypatch):
    from scorelake.sources import exports

    rows = [(i, f'text "{i}"\nline, {i}' if i % 5 else None) for i in range(95)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(4)
    path = str(tmp_path / "ordered")
    listed = sl.export_ordered(df, path, ["k"], max_rows=10, chunks_per_job=4).orderBy("chunk").collect()
    assert [(r["chunk"], r["rows"]) for r in listed] == [(c, 10 if c < 9 else 5) for c in range(10)]
    back = sl.read_ordered(spark, path, "k int, t string")
    assert sorted((r["chunk"], r["k"], r["t"]) for r in back.collect()) == [(k // 10, k, t) for k, t in rows] or [
        (r["chunk"], r["k"], r["t"]) for r in back.orderBy("k").collect()
    ] == [(k // 10, k, t) for k, t in rows]
    assert sl.changed_chunks(spark, path).collect() == []
    # Within a file the rows are in order.
    with open(f"{path}/{listed[3]['file']}") as f:
        assert [int(line.split(",")[0]) for line in f.read().splitlines() if line[:2].isdigit()] == list(range(30, 40))

    # A stopped export goes on behind the last job that finished.
    stopped, waves, real = str(tmp_path / "stopped"), [], exports.manifest

    class Stop(Exception):
        pass

    original = type(df.write).save

    def save(writer, target=None, *args, **kwargs):
        if target == stopped:
            waves.append(1)
            if len(waves) == 3:
                raise Stop
        return original(writer, target, *args, **kwargs)

    monkeypatch.setattr(type(df.write), "save", save)
    with pytest.raises(Stop):
        sl.export_ordered(df, stopped, ["k"], max_rows=10, chunks_per_job=3)
    assert real(spark, stopped).count() == 6 and len(waves) == 3
    again = sl.export_ordered(df, stopped, ["k"], max_rows=10, chunks_per_job=3)
    assert len(waves) == 5 and sorted((r["chunk"], r["checksum"]) for r in again.collect()) == [(r["chunk"], r["checksum"]) for r in listed]
    # One that is done writes nothing.
    assert sl.export_ordered(df, stopped, ["k"], max_rows=10).count() == 10 and len(waves) == 5
    monkeypatch.undo()
    # Missing and changed files are found.
    folder, _, name = next(r["file"] for r in again.collect() if r["chunk"] == 2).partition("/")
    with open(f"{stopped}/{folder}/{name}", "a") as f:
        f.write("99,more\n")
    os.remove(f"{stopped}/{folder}/.{name}.crc")
    assert [(r["chunk"], r["problem"]) for r in sl.changed_chunks(spark, stopped).collect()] == [(2, "changed")]
    assert sl.export_ordered(df.limit(0), str(tmp_path / "none"), ["k"]).collect() == []
    with pytest.raises(ValueError):
        sl.export_ordered(df.withColumnRenamed("t", "Chunk"), str(tmp_path / "clash"), ["k"])


def test_save_table_modes(spark, items):
    assert sl.save_table(items, "t", columns=["id", "name"], column_names=["k", "v"]) == "t"
    assert spark.table("t").columns == ["k", "v"]
    with pytest.raises(Exception, match="(?i)already exists"):
        sl.save_table(items, "t")
    other = sl.save_table(items, "t", if_exists="silent")
    assert other != "t" and sl.table_exists(spark, other) and spark.table("t").columns == ["k", "v"]
    assert sl.save_table(items, "t", if_exists="replace") == "t" and spark.table("t").columns == items.columns
    with pytest.raises(ValueError):
        sl.save_table(items, "t", if_exists="ignore")
    assert sl.table_exists(spark, sl.save_table(items))


def test_insert_rows_by_position(spark, items):
    sl.insert_rows(items.where("id < 5"), "made", columns=["id", "name"])
    sl.insert_rows(items.where("id >= 5").selectExpr("id AS other", "name AS x"), "made")
    assert spark.table("made").columns == ["id", "name"] and spark.table("made").count() == 1000


def test_table_ddl_and_catalog(spark, items):
    spark.sql("CREATE TABLE src (id BIGINT COMMENT 'the key', name STRING) USING parquet")
    sl.insert_rows(items.select("id", "name"), "src")
    sl.create_like(spark, "copy", "src")
    assert spark.table("copy").columns == ["id", "name"] and spark.table("copy").count() == 0
    sl.rename_table(spark, "copy", "renamed")
    items.createOrReplaceTempView("a_view")
    assert set(sl.list_tables(spark)) == {"src", "renamed", "a_view"} and sl.list_views(spark) == ["a_view"]
    assert "default" in sl.list_schemas(spark) and not sl.table_exists(spark, "copy")
    columns = {r["column_name"]: r for r in sl.list_columns(spark, "src").collect()}
    assert columns["id"]["comment"] == "the key" and columns["name"]["data_type"] == "string"
    assert sl.show_create(spark, "src").startswith("CREATE TABLE")
    assert [c["name"] for c in sl.table_detail(spark, "src")["columns"]] == ["id", "name"]
    described = {r["column_name"]: r for r in sl.describe_table(spark, "SRC").collect()}
    assert described["id"]["comments"] == "the key" and described["id"]["num_distinct"] == 1000


def test_read_table(spark, items, tmp_path):
    sl.save_table(items, "secret", encrypt=["name"], key=KEY)
    got = sl.read_table(spark, "secret", ["id"], ["i", "plain"], decrypt=["name"], key=KEY, path=str(tmp_path / "out"))
    assert got.where("i = 3").first()["plain"] == "n3"
    assert sl.read_chunks(spark, str(tmp_path / "out")).count() == 1000
    assert spark.table("secret").where("name LIKE 'n%'").count() < 1000
    assert sl.read_table(spark, "secret", ["id"], limit=7).count() == 7
    with pytest.raises(ValueError, match="key"):
        sl.read_table(spark, "secret", decrypt=["name"])


def test_read_tables_keep_order_and_errors(spark, items, tmp_path):
    sl.save_table(items, "one")
    paths = [str(tmp_path / "p1"), None, str(tmp_path / "p3")]
    got = sl.read_tables(spark, ["one", "missing", "one"], [["id"], None, ["half"]], paths=paths)
    assert got[0].columns == ["id"] and isinstance(got[1], Exception) and got[2].columns == ["half"]
    assert sl.read_chunks(spark, paths[2]).count() == 1000
    with pytest.raises(ValueError):
        sl.read_tables(spark, ["one"], [["id"], ["id"]])
    assert {r["table"]: r["rows"] for r in sl.table_sizes(spark, ["one"]).collect()} == {"one": 1000}


def test_batches_and_blocks(spark, items, tmp_path):
    pages = list(sl.iter_batches(items, 300))
    assert [len(p) for p in pages] == [300, 300, 300, 100]
    assert sorted(r["id"] for p in pages for r in p) == list(range(1000))
    with pytest.raises(ValueError):
        next(sl.iter_batches(items, 0))
    text = "".join(f"line {i}\n" for i in range(5000))
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text("short\n")
    rows = sl.read_text_blocks(spark, str(tmp_path), 10_000).collect()
    big = [r for r in rows if r["file"].endswith("a.txt")]
    assert {r["block"] for r in big} == {1, 2, 3, 4, -1}
    assert sorted(int(r["value"].split()[1]) for r in big) == list(range(5000))
    assert [r["block"] for r in rows if r["file"].endswith("b.txt")] == [-1]


def test_statements(spark, items, tmp_path):
    script = "-- first; comment\nSELECT 'a;b' AS x; ;\n/* ; */ SELECT \"c;\" AS x;\nSELECT `x;y` FROM (SELECT 1 AS `x;y`)\n--end"
    parts = sl.split_statements(script)
    assert len(parts) == 3
    (tmp_path / "s.sql").write_text(script)
    for concurrent in (False, True):
        assert [df.first()[0] for df in sl.run_sql_file(spark, str(tmp_path / "s.sql"), concurrent=concurrent)] == ["a;b", "c;", 1]
    items.createOrReplaceTempView("items")
    assert sl.run_sql(spark, "SELECT * FROM items WHERE id < :n;", {"n": 5}).count() == 5
    assert sl.run_sql(spark, "SELECT * FROM items", n_rows=3).count() == 3
    assert sl.run_sql(spark, "SELECT * FROM items", n_rows=0).count() == 0
    assert sl.run_sql(spark, "SELECT * FROM items", n_rows=-1).count() == 1000
    assert sl.run_sql(spark, "SELECT * FROM items WHERE id = ?", [4]).first()["name"] == "n4"
    unions = " UNION ALL ".join("SELECT count(*) FROM items" for _ in range(4))
    assert sl.run_sql(spark, unions).count() == 4


def test_concurrent_statements(spark, items):
    items.createOrReplaceTempView("items")
    sqls = ["SELECT count(*) FROM items", "SELECT nope FROM items", "SELECT 1 / 0", "SELECT max(id) FROM items"]
    got = sl.run_sqls(spark, sqls, action=lambda df: df.first()[0])
    assert got[0] == 1000 and got[3] == 999
    assert isinstance(got[1], Exception) and isinstance(got[2], Exception)
    futures = sl.run_sqls(spark, "SELECT 1; SELECT 2", sync=False, action=lambda df: df.first()[0])
    assert [f.result() for f in futures] == [1, 2]
    per = sl.run_sqls(spark, ["SELECT :a", "SELECT :a"], args=[{"a": 1}, {"a": 2}], action=lambda df: df.first()[0])
    assert per == [1, 2]
    zones = [{"spark.sql.session.timeZone": z} for z in ("UTC", "Asia/Tokyo")]
    assert sl.run_sqls(spark, ["SELECT current_timezone()"] * 2, conf=zones, action=lambda df: df.first()[0]) == ["UTC", "Asia/Tokyo"]


def test_options_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sl.with_conf(spark, {"spark.sql.shuffle.partitions": "3", "my.option": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and spark.conf.get("my.option", None) is None
    spark.conf.set("my.option", "y")
    with sl.with_conf(spark, unset=("my.option",)):
        assert spark.conf.get("my.option", None) is None
    assert spark.conf.get("my.option") == "y"
    spark.conf.unset("my.option")


def test_database_is_put_back(spark, items):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    spark.sql("CREATE TABLE IF NOT EXISTS other.t USING parquet AS SELECT 5 AS x")
    assert sl.run_sql(spark, "SELECT x FROM t", database="other").first()["x"] == 5
    assert spark.catalog.currentDatabase() == "default"
    assert sl.run_sqls(spark, ["SELECT x FROM t"] * 2, database="other", action=lambda df: df.first()[0]) == [5, 5]
    spark.sql("DROP DATABASE other CASCADE")


def test_encryption(spark, items):
    hidden = sl.encrypt_columns(items, ["name", "id"], KEY)
    assert hidden.where("name LIKE 'n%'").count() < 1000
    back = sl.decrypt_columns(hidden, ["name", "id"], F.lit(KEY)).where("id = '12'").first()
    assert back["name"] == "n12"
    with pytest.raises(ValueError):
        sl.encrypt_columns(items, ["gone"], KEY)


def test_jdbc_options():
    assert sl.doris_url("h", "db") == "jdbc:mysql://h:9030/db" and sl.doris_url("h") == "jdbc:mysql://h:9030/"
    assert sl.oracle_url("h", sid="S") == "jdbc:oracle:thin:@h:1521:S"
    assert sl.oracle_url("h", "svc", port=9) == "jdbc:oracle:thin:@//h:9/svc"
    with pytest.raises(ValueError):
        sl.oracle_url("h")
    assert read_options("u", "me", "pw", query="SELECT 1;") == {
        "url": "u", "fetchsize": "32768", "user": "me", "password": "pw", "query": "SELECT 1",
    }
    split = read_options("u", query="SELECT 1;", partition_column="k", bounds=(0, 10), num_partitions=4)
    assert split["dbtable"] == "(SELECT 1) q" and split["lowerBound"] == "0" and split["numPartitions"] == "4"
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "k"}):
        with pytest.raises(ValueError):
            read_options("u", **bad)
    assert write_options("u", "t") == {"url": "u", "dbtable": "t", "batchsize": "1024"}
