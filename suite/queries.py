"""One query per operator, over whole tables of a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import scorelake as sl
from scorelake.sources.scratch import scratch_path

CUTOFFS = ["1997-01-01", "1999-01-01"]
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
KEY = "0123456789abcdef"  # for the round trip only
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unregistered(spark: SparkSession, df: DataFrame, *names: str) -> DataFrame:
    """A result whose tables leave the catalog; files at a path of their own are deleted with the application."""
    df.schema  # noqa: B018 - resolved while the tables are there
    for name in names:
        sl.drop_table(spark, name)
    return df


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label, a tied and an almost untied score."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "*", "int(l_returnflag = 'R') AS label", "bround(l_discount + l_tax, 2) AS score", "l_extendedprice AS price"
    )


def rounded(df: DataFrame, digits: int = 6, drop: tuple[str, ...] = ("bin_lo", "bin_hi")) -> DataFrame:
    """Doubles rounded, so that the last bits of two engines may differ."""
    kept = [(n, t) for n, t in df.dtypes if n not in drop]
    return df.select(*[F.bround(F.col(n), digits).alias(n) if t == "double" else F.col(n) for n, t in kept])


# Bin statistics


@query
def bin_stat_price(spark, sf_dir):
    return rounded(sl.bin_stat(scored(spark, sf_dir), "price", "label", bins=5, precision=2))


@query
def bin_stat_equal_width(spark, sf_dir):
    df = scored(spark, sf_dir)
    return rounded(sl.bin_stat(df, "price", "label", bins=8, cut_method="percentile", ascending=False, precision=1))


@query
def bin_stat_two_features(spark, sf_dir):
    return rounded(sl.bin_stat(scored(spark, sf_dir), ["price", "l_quantity"], "label", bins=10).drop("bin_label"))


@query
def bin_stat_fixed_edges_left(spark, sf_dir):
    df = scored(spark, sf_dir)
    return rounded(sl.bin_stat(df, "l_quantity", "label", bins=[5, 10, 20, 40], closed="left", fillna="outside"))


@query
def psi_by_bin(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("decision", sl.predict("score", 0.08))
    return rounded(sl.bin_stat(df, "price", "label", "decision", bins=5, precision=2))


@query
def doc_quality_bins(spark, sf_dir):
    df = sl.join_on(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), ["doc_id"])
    return rounded(sl.bin_stat(df, "n_chars", "quality", bins=4, precision=0))


@query
def cut_bin_labels(spark, sf_dir):
    cut = sl.cut_bin(scored(spark, sf_dir), "l_quantity", bins=[1, 10, 25, 45], fillna="none")
    return cut.groupBy(F.col("l_quantity_bin.label").alias("label")).agg(F.count("*").alias("rows"))


@query
def quantile_edges(spark, sf_dir):
    edges = sl.quantile_edges(scored(spark, sf_dir), ["price", "l_quantity"], 10)
    rows = [(name, i, e) for name, values in edges.items() for i, e in enumerate(values)]
    return rounded(spark.createDataFrame(rows, "feature string, i int, edge double"))


# ROC, AUC, KS, class statistics


@query
def roc_curve_ties(spark, sf_dir):
    curve = sl.roc_curve(scored(spark, sf_dir), "label", "score", drop_intermediate=False)
    return rounded(curve)


@query
def roc_curve_null_keys(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("status", F.expr("nullif(l_linestatus, 'O')"))
    return rounded(sl.roc_curve(df, "label", "score", keys=["status"], drop_intermediate=False, rows_per_cell=5))


@query
def auc_null_keys(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("status", F.expr("nullif(l_linestatus, 'O')"))
    return rounded(sl.auc(df, "label", "price", keys=["status"], rows_per_cell=2000))


@query
def roc_curve_kept_points(spark, sf_dir):
    curve = sl.roc_curve(scored(spark, sf_dir), "label", "price")
    return rounded(curve, 9)


@query
def auc_right(spark, sf_dir):
    return rounded(sl.auc(scored(spark, sf_dir), "label", "price", rule="right"))


@query
def auc_trapezoid(spark, sf_dir):
    return rounded(sl.auc(scored(spark, sf_dir), "label", "score"))


@query
def auc_of_class(spark, sf_dir):
    return rounded(sl.auc(scored(spark, sf_dir), "l_returnflag", "score", pos_label="A"))


@query
def ks(spark, sf_dir):
    return rounded(sl.ks(scored(spark, sf_dir), "label", "price"))


@query
def auc_weighted(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("w", F.expr("l_quantity - 1"))
    return rounded(sl.roc_summary(df, "label", "score", "w").select("auc_trapezoid", "auc_right", "ks"))


@query
def class_stats(spark, sf_dir):
    return rounded(sl.classification_stats(scored(spark, sf_dir), "label", "score", 0.08))


@query
def class_stats_weighted(spark, sf_dir):
    return rounded(sl.classification_stats(scored(spark, sf_dir), "label", "score", 0.08, "l_quantity"))


@query
def target_type(spark, sf_dir):
    types = sl.target_types(scored(spark, sf_dir), ["label", "score", "l_linenumber", "l_quantity"])
    return spark.createDataFrame(list(types.items()), "column_name string, type string")


# Reports


@query
def binary_report(spark, sf_dir):
    return sl.binary_report(scored(spark, sf_dir), "label", "score", threshold=0.08)[0]


@query
def binary_report_bins(spark, sf_dir):
    report = sl.binary_report(scored(spark, sf_dir), "label", "score", threshold=0.08, bin_x="price", bins=6)
    return rounded(report[1].drop("bin_label"))


@query
def model_report(spark, sf_dir):
    return sl.model_report(scored(spark, sf_dir), "label", "score")[0]


@query
def binary_report_by_date(spark, sf_dir):
    df = scored(spark, sf_dir)
    return sl.binary_report_by_date(df, "label", "score", "l_shipdate", CUTOFFS, threshold=0.08)[0]


@query
def bin_stat_by_date(spark, sf_dir):
    df = scored(spark, sf_dir)
    binned = sl.binary_report_by_date(df, "label", "score", "l_shipdate", CUTOFFS, bin_x="price", bins=5)[1]
    return binned.drop("bin_label", "bin_lo", "bin_hi")


@query
def pivot_by_date(spark, sf_dir):
    df = scored(spark, sf_dir)
    edges = [0, 20000, 50000, 80000, 200000]
    binned = sl.binary_report_by_date(df, "label", "score", "l_shipdate", CUTOFFS, bin_x="price", bins=edges)[1]
    ranges = sl.date_ranges(df, "l_shipdate", CUTOFFS)
    wide = sl.pivot_by_date(binned, ranges, ["bin_num", "bad_num"], ["bin_label"])
    names = [f"r{i}_{stat}" for i in range(len(ranges)) for stat in ("bin_num", "bad_num")]
    return wide.toDF("bin_label", *names)


@query
def pivot_performance(spark, sf_dir):
    df = with_cut(spark, sf_dir)
    ranges = sl.date_ranges(df, "l_shipdate", CUTOFFS)
    wide = sl.pivot_by_date(sl.performance_by_date(df, "label", "cut", "l_shipdate", CUTOFFS), ranges, ["TOTAL", "BAD_NUM"])
    return wide.toDF("SCORE_CUT", *[f"r{i}_{stat}" for i in range(len(ranges)) for stat in ("TOTAL", "BAD_NUM")])


def with_cut(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("cut", F.floor(F.col("price") / 10000).cast("int"))


@query
def performance_table(spark, sf_dir):
    return sl.performance_table(with_cut(spark, sf_dir), "label", "cut", ascending=False)


@query
def performance_by_date(spark, sf_dir):
    return sl.performance_by_date(with_cut(spark, sf_dir), "label", "cut", "l_shipdate", CUTOFFS)


@query
def performance_auc_by_date(spark, sf_dir):
    parts = sl.performance_by_date(with_cut(spark, sf_dir), "label", "cut", "l_shipdate", CUTOFFS, score="price")
    return rounded(parts[1])


@query
def date_ranges(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    ranges = sl.date_ranges(df, "o_orderdate", CUTOFFS)
    return sl.with_date_range(df, "o_orderdate", ranges).groupBy("date_range").agg(F.count("*").alias("rows"))


@query
def filter_dates(spark, sf_dir):
    df = sl.filter_dates(table(spark, sf_dir, "orders"), "o_orderdate", *CUTOFFS)
    return df.groupBy("o_orderpriority").agg(F.count("*").alias("rows"))


# Profiles and types


@query
def nunique(spark, sf_dir):
    return sl.nunique(table(spark, sf_dir, "lineitem"))


@query
def nunique_rows(spark, sf_dir):
    df = sl.nunique(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber", "l_suppkey"], axis=1)
    return df.groupBy("nunique").agg(F.count("*").alias("rows"))


@query
def nunique_rows_text(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "9007199254740992 + o_orderkey % 2 AS a", "9007199254740993L AS b")
    whole = sl.nunique(df, ["a", "b", "o_custkey"], axis=1).select("o_orderkey", F.col("nunique").alias("whole"))
    texts = table(spark, sf_dir, "documents").selectExpr("doc_id AS o_orderkey", "lang", "source", "text")
    words = sl.nunique(texts, ["lang", "source", "text"], axis=1).select("o_orderkey", F.col("nunique").alias("words"))
    return sl.stitch_columns([whole, words], "o_orderkey")


@query
def column_profile(spark, sf_dir):
    return rounded(sl.column_profile(table(spark, sf_dir, "customer")).drop("comment", "data_precision"), 9)


@query
def describe_table(spark, sf_dir):
    name = sl.save_table(table(spark, sf_dir, "part"), path=scratch_path(spark, "part"))
    return unregistered(spark, rounded(sl.describe_table(spark, name).drop("data_precision", "comments"), 9), name)


@query
def column_sizes(spark, sf_dir):
    return sl.column_sizes(table(spark, sf_dir, "documents"))


@query
def result_size(spark, sf_dir):
    return sl.result_size(table(spark, sf_dir, "orders"))


@query
def table_sizes(spark, sf_dir):
    return sl.table_sizes(spark, {name: table(spark, sf_dir, name) for name in TABLES})


@query
def shrink_types(spark, sf_dir):
    return sl.shrink_types(table(spark, sf_dir, "part"))


@query
def normalize_decimals(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_totalprice AS decimal(12,2)) AS price", "cast(o_custkey AS decimal(12,2)) AS customer"
    )
    return sl.normalize_decimals(df)


@query
def cast_schema(spark, sf_dir):
    types = {"o_totalprice": "decimal(12, 2)", "o_orderdate": "datev2", "o_custkey": "int", "o_orderstatus": "varchar(10)"}
    return sl.cast_schema(table(spark, sf_dir, "orders"), types)


@query
def human_size(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", sl.human_size(F.octet_length("text") * F.col("n_chars")).alias("size")
    )


# Columns and rows


@query
def read_table_subset(spark, sf_dir):
    return sl.read_table(spark, table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], ["order_id", "price"])


@query
def rename_columns(spark, sf_dir):
    return sl.rename_columns(table(spark, sf_dir, "customer"), ["id", "name", "nation", "balance", "segment"])


@query
def strip_qualifiers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sl.strip_qualifiers(orders.toDF("orders.o_orderkey", "db.orders.o_orderstatus"))


@query
def select_regex(spark, sf_dir):
    return sl.select_regex(table(spark, sf_dir, "customer"), "c_(custkey|name)")


@query
def drop_columns(spark, sf_dir):
    return sl.drop_columns(table(spark, sf_dir, "orders"), "o_orderdate", "o_custkey")


@query
def binarize(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", sl.binarize("o_orderstatus", "F").alias("is_f"))


@query
def extract_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sl.extract_id("props", r'.*"k": (\d+).*').alias("k"))


@query
def usage_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS custkey", "bigint(o_totalprice * 100) AS memory")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS custkey", "c_name")
    return sl.usage_report(orders, customers, "custkey", "memory")


@query
def join_three_keys(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    items = table(spark, sf_dir, "lineitem")
    totals = items.groupBy(*keys).agg(F.sum("l_quantity").alias("total"))
    return sl.join_on(items.select(*keys, "l_linenumber"), totals, keys)


@query
def stitch_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    slices = [["o_custkey", "o_orderstatus"], ["o_totalprice"], ["o_orderpriority"]]
    return sl.stitch_columns([orders.select("o_orderkey", *s) for s in slices], "o_orderkey")


@query
def first_per_key(spark, sf_dir):
    return sl.first_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def stack(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = [r[0] for r in orders.select("o_orderstatus").distinct().collect()]
    states = [orders.where(F.col("o_orderstatus").eqNullSafe(s)) for s in found]
    return sl.stack(states).groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


@query
def row_numbers(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return sl.row_numbers(df, ["o_orderdate", "o_orderkey"])


@query
def page_of_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return sl.PageIndex(orders, ["o_totalprice", "o_orderkey"], rows_per_cell=2000).page(3, 300)


@query
def chunk_ids(spark, sf_dir):
    return sl.chunk_ids(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 1000)


@query
def bin_stat_many_groups(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr("int(l_suppkey % 97) AS g", "int(l_returnflag = 'R') AS y", "l_extendedprice", "l_quantity", "l_discount")
    groups = (F.col("g"), [str(i) for i in range(97)], "group")
    stats = sl.bin_stat(df, ["l_extendedprice", "l_quantity", "l_discount"], "y", bins=4, group=groups)
    return stats.select("group", "feature", "bin", "bin_num", F.col("bad_num").cast("bigint").alias("bad_num"))


# Sinks, read back


@query
def export_chunked(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = sl.export_chunked(orders, scratch_path(spark, "export"), max_rows=5000)
    return sl.read_chunks(spark, path, schema=orders.schema)


@query
def export_by_chunk_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    chunks = sl.chunk_ids(orders, ["o_orderkey"], 4000)
    path = sl.export_chunked(chunks, scratch_path(spark, "chunks"), format="parquet", partition_by="chunk")
    return sl.read_chunks(spark, path, "parquet").groupBy("chunk").agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )


@query
def export_ordered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "ordered")
    files = sl.export_ordered(orders, path, ["o_totalprice", "o_orderkey"], 2000)
    rows = sl.read_ordered(spark, path, orders.schema)
    return rows.join(files.select("chunk", "rows"), "chunk")


@query
def split_table(spark, sf_dir):
    conditions = {"open": "o_orderstatus = 'O'", "dear": "o_totalprice >= 250000"}
    paths = sl.split_table(table(spark, sf_dir, "orders"), scratch_path(spark, "split"), conditions)
    parts = [spark.read.parquet(path).select(F.lit(name).alias("part"), "o_orderkey") for name, path in paths.items()]
    return sl.stack(parts)


@query
def write_csv(spark, sf_dir):
    names = ["id", "name", "nation", "balance", "segment"]
    path = sl.write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "csv"), names)
    return sl.load_file(spark, path, "csv", "id bigint, name string, nation int, balance double, segment string")


def csv_round_trip(name):
    """A whole table exported and read back: cells with line feeds, quotes and microseconds must survive."""

    def run(spark, sf_dir):
        df = table(spark, sf_dir, name)
        path = sl.export_chunked(df, scratch_path(spark, f"csv-{name}"), max_rows=2000)
        return sl.read_chunks(spark, path, schema=df.schema)

    QUERIES[f"csv_{name}"] = run


for _name in ("documents", "pages", "conversations", "events"):
    csv_round_trip(_name)


@query
def append_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "append")
    sl.append_csv(orders.where("o_totalprice < 200000"), path)
    sl.append_csv(orders.where("NOT coalesce(o_totalprice < 200000, false)"), path)
    return sl.load_file(spark, path, "csv", orders.schema)


@query
def save_table_replace(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), scratch_path(spark, "table")
    name = sl.save_table(orders.select("o_orderkey"), path=path)
    sl.save_table(orders, name, if_exists="replace", columns=["o_orderkey", "o_custkey"], path=path)
    return unregistered(spark, spark.table(name), name)


@query
def insert_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    name = sl.save_table(customers.where("c_custkey < 50"), path=scratch_path(spark, "insert"))
    sl.insert_rows(customers.where("NOT coalesce(c_custkey < 50, false)"), name, column_names=["id", "label"])
    return unregistered(spark, spark.table(name), name)


@query
def encrypt_roundtrip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "secret")
    sl.encrypt_columns(customers, ["c_name"], KEY).write.parquet(path)
    stored = spark.read.parquet(path)
    return sl.decrypt_columns(stored.withColumn("readable", F.col("c_name").contains("Customer")), ["c_name"], KEY)


@query
def save_table_silent(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    name = sl.save_table(customers.selectExpr("c_name AS value"), path=scratch_path(spark, "first"))
    other = sl.save_table(
        customers.selectExpr("cast(c_custkey AS string) AS value"), name, if_exists="silent", path=scratch_path(spark, "second")
    )
    return unregistered(spark, sl.stack([spark.table(name), spark.table(other)]), name, other)


@query
def create_like_rename(spark, sf_dir):
    name = sl.save_table(table(spark, sf_dir, "nation"), path=scratch_path(spark, "nation"))
    copy, path = f"{name}_copy", scratch_path(spark, "copy")
    sl.create_like(spark, copy, name)
    sl.insert_rows(spark.table(name), copy)
    sl.rename_table(spark, copy, f"{copy}_renamed")
    spark.table(f"{copy}_renamed").write.parquet(path)
    return unregistered(spark, spark.read.parquet(path), name, f"{copy}_renamed")


@query
def read_table_decrypted(spark, sf_dir):
    path = scratch_path(spark, "secret")
    sl.encrypt_columns(table(spark, sf_dir, "customer"), ["c_name"], KEY).write.parquet(path)
    stored = spark.read.parquet(path).orderBy("c_custkey")
    return sl.read_table(spark, stored, ["c_custkey"], ["id", "name"], decrypt=["c_name"], key=KEY, limit=100)


@query
def load(spark, sf_dir):
    return sl.load(spark, f"{sf_dir}/supplier.parquet")


# Statements


@query
def with_conf(spark, sf_dir):
    path = scratch_path(spark, "conf")
    with sl.with_conf(spark, {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "false"}):
        rows = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("rows"))
        rows.withColumn("partitions", F.lit(rows.rdd.getNumPartitions())).write.parquet(path)
    return spark.read.parquet(path)


@query
def run_sql_database(spark, sf_dir):
    database = f"suite_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    name = sl.save_table(table(spark, sf_dir, "orders"), f"{database}.orders", path=scratch_path(spark, "orders"))
    rows = sl.run_sql(spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000", database=database)
    unregistered(spark, rows, name)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return rows


def sql_of(sf_dir, name):
    return f"parquet.`{sf_dir}/{name}.parquet`"


@query
def run_sql_params(spark, sf_dir):
    text = f"SELECT o_orderkey, o_totalprice FROM {sql_of(sf_dir, 'orders')} WHERE o_orderstatus = :s AND o_totalprice > :p;"
    return sl.run_sql(spark, text, {"s": "O", "p": 100000.0})


@query
def run_sql_script(spark, sf_dir):
    script = f"""
        -- a ; in a comment
        SELECT 'a;b' AS name, count(*) AS rows FROM {sql_of(sf_dir, "orders")};
        ;
        SELECT 'c' AS name, count(*) AS rows FROM {sql_of(sf_dir, "lineitem")} WHERE l_returnflag <> ';'
    """
    return sl.stack(sl.run_sql_script(spark, script))


@query
def run_sqls(spark, sf_dir):
    statements = [
        f"SELECT '{name}' AS name, count(*) AS rows FROM {sql_of(sf_dir, name)}" for name in ("orders", "lineitem", "part")
    ]
    failing = "SELECT missing FROM " + sql_of(sf_dir, "orders")
    results = sl.run_sqls(spark, [*statements, failing])
    rows = [r for r in results if not isinstance(r, Exception)]
    errors = F.lit(len(results) - len(rows)).alias("errors")
    return sl.stack(rows).select("name", "rows", errors)


@query
def union_all_sql(spark, sf_dir):
    found = [r[0] for r in table(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect()]
    parts = [
        f"SELECT o_orderstatus AS status, sum(o_totalprice) AS total FROM {sql_of(sf_dir, 'orders')} "
        f"WHERE o_orderpriority <=> :p{i} GROUP BY o_orderstatus"
        for i in range(len(found))
    ]
    return rounded(sl.run_sql(spark, " UNION ALL ".join(parts), {f"p{i}": p for i, p in enumerate(found)}), 2)


@query
def limit_rows(spark, sf_dir):
    text = f"SELECT o_orderkey, o_totalprice FROM {sql_of(sf_dir, 'orders')} ORDER BY o_totalprice DESC, o_orderkey"
    return sl.run_sql(spark, text, n_rows=100)


@query
def read_tables(spark, sf_dir):
    frames = [table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")]
    columns = [["o_orderkey"], ["c_custkey"], ["missing"]]
    results = sl.read_tables(spark, frames, columns, [["id"], ["id"], None])
    return reduce(DataFrame.unionByName, [r for r in results if not isinstance(r, Exception)])


# Text


@query
def clean_text(spark, sf_dir):
    return sl.clean_columns(table(spark, sf_dir, "pages"))


@query
def read_text_blocks(spark, sf_dir):
    path = scratch_path(spark, "text")
    lines = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey DIV 5000 AS part", "o_orderkey", "concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority) AS value"
    )
    # A file for each range of keys, in a known order, so that the bytes before each line are known.
    dealt = lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value")
    dealt.write.partitionBy("part").text(path)
    blocks = sl.read_text_blocks(spark, path, 64 * 1024)
    # A line belongs to the block of 64 KiB in which it starts; a file of one block has only the last, -1.
    part = F.regexp_extract("file", r"/part=(\d+)/", 1).cast("bigint").alias("part")
    return blocks.groupBy(part, "block").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


def marked_turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "concat('%', role, '\\n', text) AS text")


@query
def assemble_documents(spark, sf_dir):
    return sl.assemble_documents(marked_turns(spark, sf_dir), "conv_id", "turn", "text")


@query
def split_documents(spark, sf_dir):
    scripts = sl.assemble_documents(marked_turns(spark, sf_dir), "conv_id", "turn", "text")
    return sl.split_documents(scripts, "conv_id", "script")
