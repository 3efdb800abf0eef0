import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import scorelake as sl
from scorelake.operators.performance import PERFORMANCE_COLUMNS

D = dt.datetime


@pytest.fixture(scope="module")
def loans(spark):
    r = random.Random(4)
    start = D(2023, 6, 9)
    rows = []
    for i in range(900):
        day = start + dt.timedelta(days=r.randrange(130))
        if D(2023, 8, 1) <= day < D(2023, 9, 1):
            continue
        score = r.random()
        rows.append((i, day, score, int(r.random() < score), float(r.randrange(300, 900)), float(r.randrange(3))))
    df = spark.createDataFrame(rows, "id int, day timestamp_ntz, score double, y int, points double, w double")
    return df.cache()


def labels(df, cutoffs, **options):
    return [r.label for r in sl.date_ranges(df, "day", cutoffs, **options)]


def dated(spark, *days):
    return spark.createDataFrame([(D.fromisoformat(d),) for d in days], "day timestamp_ntz")


def test_ranges_cover_first_and_last_day(spark):
    df = dated(spark, "2023-01-05", "2023-02-10", "2023-03-20")
    assert labels(df, ["2023-02-01", "2023-03-01"]) == [
        "20230105 ~ 20230131", "20230201 ~ 20230228", "20230301 ~ 20230320",
    ]
    ranges = sl.date_ranges(df, "day", ["2023-02-01", "2023-03-01"])
    assert [r.rows for r in ranges] == [1, 1, 1] and ranges[-1].end == D(2023, 3, 21)
    assert labels(df, ["20230201"], datetime_format="%Y%m%d", strftime="%d.%m.", sep="-") == ["05.01.-31.01.", "01.02.-20.03."]


def test_start_of_empty_range_is_carried_over(spark):
    df = dated(spark, "2023-01-05", "2023-05-10")
    assert labels(df, ["2023-02-01", "2023-03-01", "2023-04-01"]) == ["20230105 ~ 20230131", "20230201 ~ 20230510"]


def test_cutoffs_outside_the_data(spark):
    df = dated(spark, "2023-01-05", "2023-05-10")
    # Ends are added around the sorted cutoffs, not sorted in.
    assert labels(df, ["2022-01-01", "2023-03-01"]) == ["20230105 ~ 20230228", "20230301 ~ 20230510"]
    assert labels(df, ["2023-03-01", "2024-01-01"]) == ["20230105 ~ 20230228", "20230301 ~ 20231231"]


def test_cutoffs_equal_to_the_ends(spark):
    df = dated(spark, "2023-01-05", "2023-05-10")
    assert labels(df, [D(2023, 1, 5), D(2023, 5, 10)]) == ["20230105 ~ 20230510"]
    # Text never equals a date: the last day becomes a range of its own.
    assert labels(df, ["2023-05-10"]) == ["20230105 ~ 20230509", "20230510 ~ 20230510"]


@pytest.mark.parametrize("kind", ["date", "timestamp", "string", "timestamp_ntz"])
def test_kinds_of_date_columns(spark, kind):
    df = dated(spark, "2023-01-05", "2023-02-01", "2023-05-10").withColumn("day", F.col("day").cast(kind))
    ranges = sl.date_ranges(df, "day", ["2023-02-01"])
    marked = sl.with_date_range(df, "day", ranges)
    assert [r["date_range"] for r in marked.collect()] == ["20230105 ~ 20230131"] + ["20230201 ~ 20230510"] * 2
    assert sl.filter_dates(df, "day", "2023-01-05", "2023-02-01").count() == 1


def test_no_dates(spark):
    df = spark.createDataFrame([(None,)], "day timestamp_ntz")
    assert sl.date_ranges(df, "day", ["2023-02-01"]) == []
    assert sl.with_date_range(df, "day", []).first()["date_range"] is None


def test_report_by_date_equals_report_of_each_range(loans):
    cutoffs = ["2023-08-05", "2023-08-20", "2023-09-15"]
    options = {"threshold": 0.4, "bin_x": ["points", "score"], "bins": 4, "weight": "w", "precision": 6}
    stats, bins = sl.binary_report_by_date(loans, "y", "score", "day", cutoffs, **options)
    stats = {r["date_range"]: r.asDict() for r in stats.collect()}
    counts = {r["date_range"]: r["count"] for r in bins.groupBy("date_range").count().collect()}
    ranges = sl.date_ranges(loans, "day", cutoffs)
    assert {r.label for r in ranges} == set(stats) == set(counts)
    for r in ranges:
        part = sl.filter_dates(loans, "day", r.start, r.end)
        alone, alone_bins = sl.binary_report(part, "y", "score", **options)
        assert part.count() == r.rows and counts[r.label] == alone_bins.count()
        assert {k: v for k, v in stats[r.label].items() if k != "date_range"} == alone.first().asDict()


def test_bins_of_each_range(loans):
    cutoffs = ["2023-08-05", "2023-09-15"]
    _, bins = sl.binary_report_by_date(loans, "y", "score", "day", cutoffs, bin_x="points", bins=4, precision=5)
    rows = bins.collect()
    for r in sl.date_ranges(loans, "day", cutoffs):
        alone = sl.binary_report(sl.filter_dates(loans, "day", r.start, r.end), "y", "score", bin_x="points", bins=4)[1]
        mine = [row.asDict() for row in rows if row["date_range"] == r.label]
        expected = [row.asDict() for row in alone.collect()]
        assert len(mine) == len(expected) > 2
        for a, b in zip(mine, expected):
            assert a["bin_label"] == b["bin_label"] and a["bin_num"] == b["bin_num"]
            assert a["lift"] == round(b["lift"], 5) and a["odds"] == round(b["odds"], 5)


def test_report_without_threshold_or_bins(loans):
    stats, bins = sl.binary_report(loans, "y", "score")
    assert stats.columns == ["auc", "ks"] and bins is None
    stats, bins = sl.binary_report_by_date(loans, "y", "score", bin_x="points", bin_stat_cols=["bin_num", "lift"])
    assert stats.count() == 1 and bins.columns[-2:] == ["bin_num", "lift"]


def test_report_with_named_labels(loans):
    named = loans.withColumn("y", F.when(F.col("y") == 1, "bad").otherwise("good"))
    options = {"threshold": 0.4, "bin_x": "points", "bins": 3}
    a = sl.binary_report(named, "y", "score", pos_label="bad", **options)
    b = sl.binary_report(loans, "y", "score", **options)
    assert a[0].collect() == b[0].collect() and a[1].collect() == b[1].collect()


def test_targets_are_checked(loans):
    with pytest.raises(ValueError):
        sl.binary_report(loans, "w", "score")
    with pytest.raises(ValueError):
        sl.binary_report(loans, "y", "points")
    with pytest.raises(NotImplementedError):
        sl.model_report(loans, "w", "score")
    stats, bins = sl.model_report(loans, "y", "score", "points", 0.5)
    assert stats.first()["support_1"] == loans.where("y = 1").count() and bins.count() == 10


def test_pivot_puts_ranges_side_by_side(loans):
    cutoffs, edges = ["2023-08-05"], [300, 500, 700, 900]
    _, bins = sl.binary_report_by_date(loans, "y", "score", "day", cutoffs, bin_x="points", bins=edges)
    ranges = sl.date_ranges(loans, "day", cutoffs)
    wide = sl.pivot_by_date(bins, ranges, ["bin_num", "lift"])
    assert wide.columns == ["feature", "bin", "bin_label", *[f"{r.label}_{s}" for r in ranges for s in ("bin_num", "lift")]]
    rows = {(b["bin_label"], b["date_range"]): b["bin_num"] for b in bins.collect()}
    for row in wide.collect():
        for r in ranges:
            assert row[f"{r.label}_bin_num"] == rows[row["bin_label"], r.label]
    one = sl.pivot_by_date(bins, ranges, ["lift"], ["bin"])
    assert one.columns == ["bin", *[f"{r.label}_lift" for r in ranges]]


def brute_performance(pairs, ascending):
    cuts = sorted({c for c, _ in pairs}, reverse=not ascending)
    total = {c: sum(1 for k, _ in pairs if k == c) for c in cuts}
    bad = {c: sum(y for k, y in pairs if k == c) for c in cuts}
    good = {c: total[c] - bad[c] for c in cuts}
    table, cum_t, cum_b, gb, gg = {}, 0, 0, 0.0, 0.0
    for c in cuts:
        cum_t, cum_b = cum_t + total[c], cum_b + bad[c]
        rate = round(bad[c] / total[c], 4)
        global_bad, global_good = round(bad[c] / sum(bad.values()), 4), round(good[c] / sum(good.values()), 4)
        gb, gg = gb + global_bad, gg + global_good
        pop = round(cum_b / cum_t, 4)
        table[c] = {
            "GOOD_NUM": good[c], "BAD_NUM": bad[c], "TOTAL": total[c], "POP": round(total[c] / len(pairs), 4),
            "ODDS": round((1 - rate) / rate, 3) if rate else None, "GOOD_RATE": round(good[c] / total[c], 4),
            "BAD_RATE": rate, "GLOBAL_BAD_RATE": global_bad, "CUM_POP_BAD_RATE": pop, "CUM_GLOBAL_BAD_RATE": round(gb, 4),
            "GLOBAL_GOOD_RATE": global_good, "CUM_GLOBAL_GOOD_RATE": round(gg, 4), "KS": round(abs(pop - round(gg, 4)), 4),
        }
    for row in table.values():
        row["TOTAL_BAD_RATE"] = table[cuts[-1]]["CUM_GLOBAL_BAD_RATE"]
        row["LIFT"] = round(abs(row["CUM_POP_BAD_RATE"] / table[cuts[-1]]["CUM_POP_BAD_RATE"]), 4)
    return table


@pytest.mark.parametrize("ascending", [True, False])
def test_performance_table(loans, ascending):
    df = loans.withColumn("cut", F.floor(F.col("points") / 100).cast("int"))
    table = sl.performance_table(df, "y", "cut", ascending)
    assert table.columns == ["SCORE_CUT", *PERFORMANCE_COLUMNS]
    got = table.collect()
    expected = brute_performance([(r["cut"], r["y"]) for r in df.collect()], ascending)
    assert [r["SCORE_CUT"] for r in got] == list(expected)
    for r in got:
        for name, value in expected[r["SCORE_CUT"]].items():
            assert r[name] == pytest.approx(value, abs=1e-9), name


def test_performance_by_date_with_area(loans):
    df = loans.withColumn("cut", F.when(F.col("points") < 600, "low").otherwise("high"))
    cutoffs = ["2023-08-05"]
    table, area = sl.performance_by_date(df, "y", "cut", "day", cutoffs, ["TOTAL", "KS"], score="score")
    assert table.columns == ["date_range", "SCORE_CUT", "TOTAL", "KS"]
    areas = {r["date_range"]: r["auc"] for r in area.collect()}
    for r in sl.date_ranges(df, "day", cutoffs):
        part = sl.filter_dates(df, "day", r.start, r.end)
        alone = sl.performance_by_date(part, "y", "cut", stat_cols=["TOTAL", "KS"])
        mine = table.where(F.col("date_range") == r.label).drop("date_range")
        assert mine.collect() == alone.collect()
        assert areas[r.label] == pytest.approx(sl.auc(part, "y", "score").first()["auc"])


def test_no_date_in_any_range(spark):
    rows = [(1, 0.5, None), (0, 0.2, None), (1, 0.7, None)]
    df = spark.createDataFrame(rows, "y int, s double, d date")
    stats, binned = sl.binary_report_by_date(df, "y", "s", "d", ["2024-01-01"], threshold=0.4, bin_x="s", bins=2, check_types=False)
    full = spark.createDataFrame([(1, 0.5, "2024-01-02"), (0, 0.2, "2024-01-03")], "y int, s double, d string")
    some = sl.binary_report_by_date(full, "y", "s", "d", ["2024-01-01"], threshold=0.4, bin_x="s", bins=2, check_types=False)
    assert stats.collect() == [] and stats.dtypes == some[0].dtypes
    assert binned.collect() == [] and binned.dtypes == some[1].dtypes


def test_many_cuts_equal_one_window(spark):
    rows = [(i % 3 == 0 and 1 or 0, (i * 37) % 211 if i % 17 else None, f"k{i % 2}") for i in range(900)]
    df = spark.createDataFrame(rows, "y int, cut int, k string")
    for up in (True, False):
        for col in ("cut", "text"):
            wide = df.withColumn("text", df["cut"].cast("string"))
            one = sl.performance_table(wide, "y", col, up, keys=["k"]).collect()
            many = sl.performance_table(wide, "y", col, up, keys=["k"], rows_per_cell=20).collect()
            assert one == many and len(one) > 300
