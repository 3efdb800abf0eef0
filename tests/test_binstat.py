import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import scorelake as sl
from scorelake.operators import binning, cells
from scorelake.operators.binstat import STATS


def brute(pairs, descending=False, preds=None):
    """Statistics per bin from (bin, label) pairs."""
    bins = sorted({b for b, _ in pairs}, reverse=descending)
    div = lambda a, b: a / b if b else None
    n = {b: sum(1 for k, y in pairs if k == b and y is not None) for b in bins}
    bad = {b: sum(y for k, y in pairs if k == b and y is not None) for b in bins}
    all_n, all_bad = sum(n.values()), sum(bad.values())
    out, cn, cb = {}, 0, 0
    for b in bins:
        cn, cb, good = cn + n[b], cb + bad[b], n[b] - bad[b]
        rate = div(bad[b], n[b])
        out[b] = {
            "bin_num": n[b], "bad_num": bad[b], "good_num": good,
            "bin_rate": div(n[b], all_n), "bad_rate": rate, "good_rate": None if rate is None else 1 - rate,
            "odds": None if not rate else (1 - rate) / rate,
            "global_bad_rate": div(bad[b], all_bad), "global_good_rate": div(good, all_n - all_bad),
            "cum_bin_bad_rate": div(cb, cn), "cum_bin_good_rate": div(cn - cb, cn),
            "cum_global_bad_rate": div(cb, all_bad), "cum_global_good_rate": div(cn - cb, all_n - all_bad),
            "lift": div(div(cb, cn) or 0, div(all_bad, all_n) or 0), "total_bad_rate": div(all_bad, all_n),
        }
    return out


def check(df, expected, pred=False):
    got = {r["bin"]: r.asDict() for r in df.collect()}
    assert got.keys() == expected.keys()
    for b, stats in expected.items():
        for name, value in stats.items():
            assert got[b][name] == (value if value is None else pytest.approx(value)), (b, name)
    return got


@pytest.mark.parametrize("ascending", [True, False])
def test_statistics_match_brute_force(spark, ascending):
    r = random.Random(1)
    data = [(r.choice([None, math.nan, 1.0, 2.0, 3.0, 4.5, 7.0]), r.choice([0, 1, 1, None])) for _ in range(400)]
    df = spark.createDataFrame(data, "x double, y int")
    edges = [1.0, 2.0, 4.0, 6.0]
    place = lambda x: None if x is None or math.isnan(x) or x > 6 else 1 if x <= 2 else 2 if x <= 4 else 3
    pairs = [(place(x), y) for x, y in data if place(x)]
    got = sl.bin_stat(df, "x", "y", bins=edges, ascending=ascending)
    check(got, brute(pairs, descending=not ascending))
    assert [r["bin"] for r in got.collect()] == ([1, 2, 3] if ascending else [3, 2, 1])
    assert [c for c in got.columns if c in STATS] == STATS and got.columns[-1] == "total_bad_rate"


def test_bin_without_bads_and_one_class(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (5.0, 1), (5.0, 0)], "x double, y int")
    df = df.withColumn("p", df.y)
    first, second = sl.bin_stat(df, "x", "y", "p", bins=[0, 2, 6]).collect()
    assert first["odds"] is None and first["psi"] is None and first["bad_rate"] == 0
    assert second["odds"] == 1 and second["psi"] == 0
    none_bad = sl.bin_stat(df.withColumn("y", df.y * 0), "x", "y", bins=[0, 2, 6]).collect()
    assert all(r["global_bad_rate"] is None and r["lift"] is None for r in none_bad)


def test_psi_compares_mean_prediction_with_bad_rate(spark):
    df = spark.createDataFrame([(1.0, 1, True)] * 3 + [(1.0, 0, False)] * 5 + [(1.0, 0, True)], "x double, y int, p boolean")
    row = sl.bin_stat(df, "x", "y", "p", bins=[0, 2]).first()
    assert row["psi"] == pytest.approx((3 / 9 - 4 / 9) * math.log((3 / 9) / (4 / 9)))


def test_two_features_and_boolean_label(spark):
    data = [(float(i), float(i % 4), i % 3 == 0) for i in range(120)]
    df = spark.createDataFrame(data, "a double, `b c` double, y boolean")
    got = sl.bin_stat(df, ["a", "b c"], "y", bins=4, stat_cols=["bin_num", "bad_num"])
    assert got.columns == ["feature", "bin", "bin_lo", "bin_hi", "bin_label", "bin_num", "bad_num"]
    rows = got.collect()
    assert [(r["feature"], r["bin"], r["bin_num"]) for r in rows[:4]] == [("a", i, 30) for i in (1, 2, 3, 4)]
    assert {r["feature"] for r in rows} == {"a", "b c"}
    single = sl.bin_stat(df, "b c", "y", bins=4, stat_cols=["bin_num", "bad_num"]).collect()
    assert rows[4:] == single


def test_features_in_several_scans(spark, monkeypatch):
    r = random.Random(9)
    data = [(r.random(), r.gauss(0, 1), float(r.randrange(5)), r.randrange(3), r.randrange(2)) for _ in range(600)]
    df = spark.createDataFrame(data, "a double, b double, c double, g int, y int")
    options = {"bins": 4, "group": (F.col("g"), ["x", "y", "z"], "name")}
    together = sl.bin_stat(df, ["a", "b", "c"], "y", **options).collect()
    monkeypatch.setattr(binning, "GROUPS_PER_PASS", 3)
    for checks in (30, 14, 0):  # fewer features per scan, then bisection
        monkeypatch.setattr(cells, "COMPILED_CHECKS", checks)
        assert sl.bin_stat(df, ["a", "b", "c"], "y", **options).collect() == together and len(together) > 30


def test_fillna_forms_a_bin(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (9.0, 0)], "x double, y int")
    rows = sl.bin_stat(df, "x", "y", bins=[0, 2], fillna="rest").collect()
    assert [(r["bin"], r["bin_label"], r["bin_num"]) for r in rows] == [(0, "rest", 2), (1, "(0.0, 2.0]", 1)]


def test_totals(spark):
    r = random.Random(5)
    df = spark.createDataFrame([(r.gauss(0, 1), r.randrange(2)) for _ in range(500)], "x double, y int")
    rows = sl.bin_stat(df, "x", "y", bins=7).collect()
    assert sum(r["bin_num"] for r in rows) == 500
    last = rows[-1]
    for name in ("cum_global_bad_rate", "cum_global_good_rate", "lift"):
        assert last[name] == pytest.approx(1)


def made_up(spark, groups, rows=3000):
    r = random.Random(groups)
    data = [
        (r.randrange(groups), float(r.randrange(30)) if r.random() > 0.1 else None, r.choice([1e7, 2.5e-5, -3.0, 1e17, 12345678.125, 0.1]) * r.randrange(5),
         float("nan") if r.random() < 0.05 else r.gauss(0, 1), int(r.random() < 0.3), r.random())
        for _ in range(rows)
    ]
    return spark.createDataFrame(data, "g int, a double, b double, c double, y int, p double").repartition(4)


@pytest.mark.parametrize("options", [{}, {"cut_method": "percentile", "closed": "left"}, {"fillna": "none", "precision": None, "ascending": False}, {"bins": 3, "pred": "p"}])
def test_edges_as_rows_equal_edges_as_text(spark, monkeypatch, options):
    df = made_up(spark, 7)
    group = (F.col("g"), [f"group {i}" for i in range(7)], "name")
    text = sl.bin_stat(df, ["a", "b", "c"], "y", group=group, **options).collect()
    monkeypatch.setattr("scorelake.operators.binstat.GROUPS_PER_PASS", 0)
    rows = sl.bin_stat(df, ["a", "b", "c"], "y", group=group, **options).collect()
    assert len(text) == len(rows) > 60
    for one, other in zip(text, rows):
        assert one.asDict().keys() == other.asDict().keys()
        for k, v in one.asDict().items():
            assert v == other[k] or (isinstance(v, float) and math.isclose(v, other[k], rel_tol=1e-12)), (k, one, other)
    whole = sl.bin_stat(df, ["a", "c"], "y", **options).collect()
    monkeypatch.undo()
    assert [r["bin_label"] for r in whole] == [r["bin_label"] for r in sl.bin_stat(df, ["a", "c"], "y", **options).collect()]


def test_plans_do_not_grow_with_the_groups(spark):
    sizes, counts = [], []
    for groups in (100, 1200):
        df = made_up(spark, groups)
        stats = sl.bin_stat(df, ["a", "b", "c"], "y", bins=4, group=(F.col("g"), list(map(str, range(groups))), "name"))
        sizes.append(len(stats._jdf.queryExecution().optimizedPlan().toString()))
        counts.append(stats.agg(F.sum("bin_num")).first()[0])
    assert sizes[1] < 1.1 * sizes[0] and min(counts) > 8000


def test_quantiles_of_many_groups_in_cells(spark):
    from scorelake.operators.many import ranked_quantiles

    r = random.Random(2)
    data = [(0 if i % 2 else r.randrange(40), float(r.randrange(400))) for i in range(5000)]
    df = spark.createDataFrame(data, "g int, v double").repartition(3)
    for rows_per_cell in (3, 100, 10**6):
        got = {row["g"]: row["values"] for row in ranked_quantiles(df, 8, rows_per_cell).collect()}
        assert len(got) == len({g for g, _ in data})
        for g, values in got.items():
            assert np.allclose(values, np.quantile([v for k, v in data if k == g], np.arange(1, 8) / 8), rtol=1e-12)


def test_numbers_are_written_with_the_fewest_digits(spark):
    from scorelake.operators.many import written_number

    r = random.Random(1)
    values = [0.0, 1.0, -0.5, 569.0, 1e15, 1e16, 1.5e16, 3.999999999999998e16, 1e-4, 9.9e-5, 2.5e-5, 1e100, 0.1 + 0.2, 1e22, float("inf"), float("-inf")]
    values += [r.uniform(-1, 1) * 10 ** r.randrange(-8, 20) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [row[0] for row in df.selectExpr(written_number("x")).collect()] == [repr(v) for v in values]
