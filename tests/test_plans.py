"""Shapes of plans that matter on large tables."""

import re

import pytest

import scorelake as sl
from scorelake.operators.cells import CutTree, balanced_cuts
from scorelake.operators.prefix import prefix_sums
from scorelake.operators.roc import score_points, scored_rows
from suite.queries import QUERIES, scored

SF = "/root/testdata/sf0.001"


def plan(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bin_stat_two_features", "binary_report_by_date", "performance_by_date", "usage_report",
                                  "first_per_key", "column_profile", "assemble_documents", "stitch_columns"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["bin_stat_price"](spark, SF))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text)[0] == "l_extendedprice:double,l_returnflag:string"


def test_date_filter_reaches_the_scan(spark):
    text = plan(QUERIES["filter_dates"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_rows_are_summed_before_the_shuffle(spark):
    text = plan(sl.bin_stat(scored(spark, SF), "price", "label", bins=[0, 10000, 200000]))
    below_first_exchange = text.split("Exchange")[-1]
    assert "partial_sum" in below_first_exchange


def test_first_per_key_needs_no_window(spark):
    text = plan(QUERIES["first_per_key"](spark, SF))
    assert "Window" not in text and "partial_min" in text


def test_cells_share_the_grouping(spark):
    """The two levels of a prefix sum read one shuffle of the points."""
    rows = scored_rows(scored(spark, SF), "label", "price")
    cuts = balanced_cuts(rows, "score", 500)
    assert len(cuts) > 5
    points = prefix_sums(score_points(rows, []), "score", ["tp", "fp"], descending=True, cuts=cuts)
    assert "ReusedExchange" in plan(points, executed=True)


def test_a_join_is_run_once_for_all_scans(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(sl.bin_stat(sl.join_on(labels, docs, ["doc_id"]), "n_chars", "quality", bins=4))
    assert "Join" not in text


def test_many_cuts_are_split_by_cell(spark):
    text = plan(sl.performance_table(scored(spark, SF), "label", "price", rows_per_cell=500))
    assert "hashpartitioning(_cell" in text and "Window" in text
    cells_only = [w for w in re.findall(r"Window \[[^\n]*", text) if "windowspecdefinition(0" in w.replace(" ", "")]
    assert all("sum_" in w or "_cell" in w for w in cells_only)


def test_row_numbers_move_rows_once(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(sl.row_numbers(df, ["o_orderdate"], rows_per_cell=200))
    assert "ExistingRDD" not in text and "SinglePartition" not in text
    # One exchange by cell; the table of offsets is broadcast.
    assert len(re.findall(r"Exchange hashpartitioning\(", text)) == 1 and "CartesianProduct" not in text


def test_plans_of_row_numbers_do_not_grow_with_the_cells(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    sizes = {}
    for rows_per_cell in (20, 10, 2):  # 300, 600 and 3000 cells
        numbered = sl.row_numbers(df, ["l_extendedprice"], rows_per_cell=rows_per_cell)
        sizes[rows_per_cell] = len(plan(numbered))
        assert len(re.findall(r"Exchange hashpartitioning\(", plan(numbered))) == 1
    assert max(sizes.values()) < 1.2 * min(sizes.values())


def test_a_cut_tree_makes_small_cells(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("l_extendedprice AS price", "l_orderkey AS k", "l_linenumber AS line")
    tree = CutTree.of(df, ["price", "k", "line"], 6000, 10)
    assert len(tree.top) == 255 and tree.lower.count() <= 256
    cells = tree.with_cell(df, "cell")
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert len(sizes) > 400 and max(sizes) < 80
    # Cells rise along the order.
    rows = cells.orderBy("price", "k", "line").collect()
    assert all(a["cell"] <= b["cell"] for a, b in zip(rows, rows[1:]))


def test_sketches_of_many_features_are_not_sorted(spark):
    from pyspark.sql import functions as F

    from scorelake.operators import cells as c

    rows = spark.range(4000).select((F.col("id") % 740).cast("int").alias("g"), F.rand(1).alias("v"))
    before = spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold")
    found = c.sketch(rows, "v", ["g"], [0.0, 1.0])
    assert len(found) == 740
    assert spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold") == before
    # 20 features with 37 cells each.
    assert c.SKETCHES_PER_TASK >= 20 * 37


def test_windows_over_points_are_split_by_cell(spark):
    rows = scored_rows(scored(spark, SF), "label", "price")
    cuts = balanced_cuts(rows, "score", 500)
    points = prefix_sums(score_points(rows, []), "score", ["tp", "fp"], descending=True, cuts=cuts)
    assert "hashpartitioning(_cell" in plan(points)

