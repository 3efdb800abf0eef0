import math
import random

import numpy as np
import pytest

import scorelake as sl
from scorelake.operators import cells
from scorelake.operators.binning import bin_edges, round_edges

INF = math.inf


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def bins_of(spark, values, edges, closed="right"):
    df = frame(spark, values).select("x", sl.assign_bin("x", edges, closed).alias("b"))
    return [r["b"] for r in df.collect()]


VALUES = [None, math.nan, -INF, 0.0, 1.0, 1.5, 2.0, 3.0, 3.5, INF]


@pytest.mark.parametrize(
    "closed, expected",
    [("right", [None, None, None, None, 1, 1, 1, 2, None, None]), ("left", [None, None, None, None, 1, 1, 2, 2, None, None])],
)
def test_outer_edges_belong_to_their_bin(spark, closed, expected):
    assert bins_of(spark, VALUES, [1.0, 2.0, 3.0], closed) == expected


@pytest.mark.parametrize("closed", ["right", "left"])
def test_infinite_ends_hold_everything_but_nan(spark, closed):
    got = bins_of(spark, VALUES, [-INF, 2.0, INF], closed)
    two = 1 if closed == "right" else 2
    assert got == [None, None, 1, 1, 1, 1, two, 2, 2, 2]


@pytest.mark.parametrize("closed", ["right", "left"])
def test_bisection_agrees_with_compiled_checks(spark, monkeypatch, closed):
    edges = [float(e) for e in range(0, 40, 2)]
    values = [None, math.nan, -INF, INF, *[i / 2 for i in range(-2, 82)]]
    compiled = bins_of(spark, values, edges, closed)
    monkeypatch.setattr(cells, "COMPILED_CHECKS", 0)
    assert bins_of(spark, values, edges, closed) == compiled
    side = "left" if closed == "right" else "right"
    for v, got in zip(values[4:], compiled[4:]):
        k = int(np.searchsorted(edges, v, side=side))
        k = 1 if closed == "right" and v == 0 else k
        k = len(edges) - 1 if closed == "left" and v == edges[-1] else k
        assert got == (k if 0 < k < len(edges) else None)


@pytest.mark.parametrize("compiled", [80, 0])
def test_cells_put_cut_values_apart(spark, monkeypatch, compiled):
    monkeypatch.setattr(cells, "COMPILED_CHECKS", compiled)
    df = frame(spark, [0.0, 1.0, 1.5, 2.0, 9.0]).selectExpr(f"{cells.cell_of('x', [1.0, 2.0])} AS c")
    assert [r["c"] for r in df.collect()] == [0, 1, 2, 3, 4]


SAMPLES = {
    "random": lambda r: [r.random() * 1000 for _ in range(3000)],
    "ties": lambda r: [float(r.randrange(7)) for _ in range(2000)],
    "hot": lambda r: [5.0] * 1500 + [r.gauss(0, 50) for _ in range(1500)],
    "hot_low": lambda r: [-9.0] * 2000 + [r.random() for _ in range(500)],
    "copies": lambda r: [1.0] * 500,
    "few": lambda r: [3.0, 1.0],
    "one": lambda r: [4.0],
    "infinite": lambda r: [-INF, -INF, INF, *[r.random() for _ in range(200)]],
}


@pytest.mark.parametrize("sample", SAMPLES)
@pytest.mark.parametrize("rows_per_cell", [20, 4_000_000])
def test_exact_quantiles_match_numpy(spark, sample, rows_per_cell):
    values = SAMPLES[sample](random.Random(7))
    df = frame(spark, [*values, None, math.nan]).repartition(4)
    got = sl.quantile_edges(df, "x", 8, rows_per_cell=rows_per_cell)["x"]
    expected = np.quantile(np.array(values), np.linspace(0, 1, 9))
    finite = [e for e in expected if math.isfinite(e)]
    assert [g for g in got if math.isfinite(g)] == pytest.approx(finite, rel=1e-12)


def test_grouped_quantiles_of_many_columns(spark):
    r = random.Random(3)
    table = [(r.random(), float(r.randrange(3)), r.gauss(0, 9), None) for _ in range(2000)]
    df = spark.createDataFrame(table, "a double, b double, c double, d double")
    got = sl.quantile_edges(df, ["a", "b", "c", "d"], 12, rows_per_cell=30)
    for i, name in enumerate("abc"):
        assert got[name] == pytest.approx(np.quantile([row[i] for row in table], np.linspace(0, 1, 13)), rel=1e-12)
    assert got["d"] is None


def test_approximate_quantiles_are_close(spark):
    values = [float(i) for i in range(20000)]
    got = sl.quantile_edges(frame(spark, values), "x", 10, method="approx")["x"]
    assert got == pytest.approx(np.quantile(values, np.linspace(0, 1, 11)), abs=100)


def test_second_level_of_cuts(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELLS_PER_LEVEL", 4)
    cuts = cells.balanced_cuts(frame(spark, [float(i) for i in range(2000)]), "x", rows_per_cell=50)
    sizes = np.histogram(range(2000), [-INF, *cuts, INF])[0]
    assert len(cuts) > 10 and max(sizes) < 250
    assert cells.balanced_cuts(frame(spark, [1.0] * 2000), "x", rows_per_cell=50) == []


def test_edges_are_unique_before_rows_are_assigned(spark):
    df = frame(spark, [1.0] * 50 + [2.0, 3.0, 4.0])
    cut, edges = sl.cut_bin(df, "x", bins=4, retbin=True)
    assert edges["x"] == [-INF, 1.0, INF]
    labels = {r["x"]: r["x_bin"]["label"] for r in cut.collect()}
    assert labels == {1.0: "(-inf, 1.0]", 2.0: "(1.0, inf]", 3.0: "(1.0, inf]", 4.0: "(1.0, inf]"}


def test_equal_width_and_infinite_range(spark):
    assert bin_edges(frame(spark, [0.0, 10.0, math.nan, None]), ["x"], 4, "percentile") == [[-INF, 2.5, 5.0, 7.5, INF]]
    with pytest.raises(ValueError, match="infinite"):
        bin_edges(frame(spark, [0.0, INF]), ["x"], 4, "percentile")


def test_precision_moves_labels_only(spark):
    df = frame(spark, [0.0, 1.004, 2.0, 3.0])
    cut = sl.cut_bin(df, "x", bins=2, precision=1)  # the edge is 1.502
    by_value = {r["x"]: r["x_bin"] for r in cut.collect()}
    assert by_value[1.004]["label"] == "(-inf, 1.6]" and by_value[1.004]["hi"] == 1.6
    left = sl.cut_bin(df, "x", bins=2, precision=1, closed="left")
    assert {r["x_bin"]["label"] for r in left.collect()} == {"[-inf, 1.5)", "[1.5, inf)"}
    assert round_edges([-INF, 0.123], None, "right") == [-INF, 0.123]
    explicit = sl.cut_bin(df, "x", bins=[0, 1.2345, 9], precision=1)
    assert explicit.first()["x_bin"]["label"] == "(0.0, 1.2345]"


def test_fillna_labels_rows_without_bin(spark):
    cut = sl.cut_bin(frame(spark, [None, math.nan, 5.0, 1.0]), "x", bins=[0, 2], fillna="it's none")
    assert [r["x_bin"]["label"] for r in cut.collect()] == ["it's none"] * 3 + ["(0.0, 2.0]"]


@pytest.mark.parametrize(
    "options",
    [{"bins": 1}, {"bins": 2.5}, {"bins": [1.0]}, {"bins": "abc"}, {"bins": 3, "cut_method": "width"}, {"bins": 3, "closed": "up"}],
)
def test_bad_options(spark, options):
    with pytest.raises(ValueError):
        sl.cut_bin(frame(spark, [1.0, 2.0]), "x", **options)


def test_column_without_values(spark):
    cut, edges = sl.cut_bin(frame(spark, [None, math.nan]), "x", bins=3, retbin=True)
    assert edges["x"] == [-INF, INF]
    assert [r["x_bin"]["label"] for r in cut.collect()] == [None, None]


def test_explicit_edges_on_a_stream(spark, tmp_path):
    frame(spark, [0.5, 1.5, 9.0]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("x double").parquet(str(tmp_path / "in"))
    counted = stream.select(sl.assign_bin("x", [0.0, 1.0, 2.0]).alias("b")).groupBy("b").count()
    running = counted.writeStream.outputMode("complete").format("memory").queryName("binned").start()
    running.processAllAvailable()
    running.stop()
    assert {r["b"]: r["count"] for r in spark.table("binned").collect()} == {1: 1, 2: 1, None: 1}


@pytest.mark.parametrize("rows_per_cell", [20, 4_000_000])
def test_wrong_sketches_do_not_change_quantiles(spark, monkeypatch, rows_per_cell):
    """Brackets that miss their rank are noticed and the gap is searched."""
    right = cells.sketch

    calls = []

    def shifted(df, value, keys, ranks, only="true", then=None):
        rows = [r.asDict(recursive=True) for r in right(df, value, keys, ranks, only, then)]
        calls.append(len(rows))
        for b in [b for r in rows for b in r["bounds"] or () if len(calls) == 1]:
            b["low"], b["high"] = b["low"] - 200, b["high"] - 200
        return rows

    monkeypatch.setattr(cells, "sketch", shifted)
    values = [float(i * 7919 % 5000) for i in range(5000)]
    got = sl.quantile_edges(frame(spark, values), "x", 5, rows_per_cell=rows_per_cell)["x"]
    assert got == pytest.approx(np.quantile(values, np.linspace(0, 1, 6)), rel=1e-12)
