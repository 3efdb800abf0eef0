import datetime
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import scorelake as sl


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0), (2, "c", 1.0)], "id int, name string, size double")


def test_select_and_rename(people):
    assert sl.select_columns(people, ["name", "id"], ["id", "size"]).columns == ["name", "id", "size"]
    with pytest.raises(ValueError, match="gone, lost"):
        sl.select_columns(people, ["id", "gone", "lost"])
    assert sl.rename_columns(people, ["x", "y", "z"]).columns == ["x", "y", "z"]
    assert sl.rename_columns(people, ["x"]).columns == people.columns
    with pytest.raises(ValueError):
        sl.rename_columns(people, ["x"], on_mismatch="raise")
    assert sl.strip_qualifiers(people.toDF("t.id", "d.t.name", "size")).columns == people.columns
    assert sl.select_regex(people, "(id|si.*)").columns == ["id", "size"]
    assert sl.drop_columns(people, "name").columns == ["id", "size"]


def test_first_per_key(spark):
    r = random.Random(2)
    data = [(r.randrange(9), r.randrange(5), r.randrange(100)) for _ in range(300)]
    df = spark.createDataFrame(data, "v int, k int, o int")
    got = {row["k"]: (row["v"], row["o"]) for row in sl.first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {k: min(((v, o) for v, a, o in data if a == k), key=lambda t: (t[1], t[0])) for k in range(5)}
    assert sl.first_per_key(df, ["k"], ["o"]).columns == ["v", "k", "o"]
    last = {row["k"]: row["o"] for row in sl.first_per_key(df, ["k"], ["o"], descending=True).collect()}
    assert last == {k: max(o for _, a, o in data if a == k) for k in range(5)}
    with_map = df.withColumn("m", F.create_map(F.col("k"), F.col("o")))
    assert all(row["m"] == {row["k"]: row["o"]} for row in sl.first_per_key(with_map, ["k"], ["o"]).collect())


def test_usage_report_and_stitch(spark):
    sessions = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k3", "z")], "k string, path string")
    procs = spark.createDataFrame([("k2", 3000), ("k1", 512), ("k9", 1)], "k string, memory long")
    report = sl.usage_report(sessions, procs, "k", "memory").collect()
    assert [(r["k"], r["memory"]) for r in report] == [("k1", "512.00 B"), ("k2", "2.93 KiB")]
    raw = sl.usage_report(sessions, procs, "k", "memory", human_readable=False, ascending=False)
    assert [r["memory"] for r in raw.collect()] == [3000, 512]
    # Every row of every slice stays, also one with a null key.
    more = procs.union(spark.createDataFrame([(None, 7)], procs.schema))
    wide = sl.stitch_columns([sessions, more, more.withColumnRenamed("memory", "m2")], "k")
    assert wide.columns == ["k", "path", "memory", "m2"]
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(
        [("k1", "x", 512, 512), ("k2", "y", 3000, 3000), ("k3", "z", None, None), ("k9", None, 1, 1), (None, None, 7, 7)], key=repr
    )


@pytest.mark.parametrize("hot", [False, True])
def test_row_numbers_and_chunks(spark, hot):
    r = random.Random(8)
    data = [(1 if hot and i % 3 else r.randrange(40), r.randrange(2 if hot else 10**6)) for i in range(1000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(6)
    numbered = sl.row_numbers(df, ["k"]).collect()
    assert sorted(x["row_number"] for x in numbered) == list(range(1, 1001))
    assert [x["k"] for x in sorted(numbered, key=lambda x: x["row_number"])] == sorted(k for k, _ in data)
    assert sorted((x["k"], x["v"]) for x in numbered) == sorted(data)
    chunks = sl.chunk_ids(df, ["k", "v"], 300).groupBy("chunk").agg(F.count("*").alias("n"), F.min("k"), F.max("k"))
    rows = sorted(chunks.collect())
    assert [(x["chunk"], x["n"]) for x in rows] == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert all(a["max(k)"] <= b["min(k)"] for a, b in zip(rows, rows[1:]))
    with pytest.raises(ValueError):
        sl.chunk_ids(df, ["k"], 0)


def test_row_numbers_of_nothing(spark):
    assert sl.row_numbers(spark.createDataFrame([], "k int"), ["k"]).count() == 0


@pytest.mark.parametrize("cuts", [[], [3.0, 10.0, 11.0], [float(i) for i in range(0, 60, 2)]])
@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums(spark, cuts, descending):
    r = random.Random(6)
    points = [(k, float(s), r.randrange(1, 9)) for k in "ab" for s in r.sample(range(80), 50)]
    df = spark.createDataFrame(points, "k string, s double, n int").repartition(5)
    got = sl.prefix_sums(df, "s", ["n"], ["k"], descending, cuts, lead=True).collect()
    for key in "ab":
        mine = sorted((p for p in points if p[0] == key), key=lambda p: -p[1] if descending else p[1])
        rows = sorted((g for g in got if g["k"] == key), key=lambda g: -g["s"] if descending else g["s"])
        running = 0
        for i, (p, g) in enumerate(zip(mine, rows)):
            running += p[2]
            following = mine[i + 1][2] if i + 1 < len(mine) else None
            assert (g["cum_n"], g["next_n"], g["total_n"]) == (running, following, sum(x[2] for x in mine))


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.125, 2.0), (None, 1.0)], "a double, b double")
    row = df.select(sl.safe_div("a", "b").alias("d"), sl.round_even("a", 2).alias("r")).collect()
    assert [r["d"] for r in row] == [None, 0.0625, None] and row[1]["r"] == 0.12
    halves = spark.createDataFrame([(2.5,), (-0.125,), (0.375,)], "x double").select(sl.round_even("x", 0), sl.round_even("x", 2))
    assert [tuple(r) for r in halves.collect()] == [(2.0, 2.5), (-0.0, -0.12), (0.0, 0.38)]
    sizes = spark.createDataFrame([(0,), (1023,), (1024,), (1536,), (1024**3 * 5,), (1024**5 * 3000,), (112768,), (None,)], "s long")
    shown = [r[0] for r in sizes.select(sl.human_size("s")).collect()]
    assert shown == ["0.00 B", "1023.00 B", "1.00 KiB", "1.50 KiB", "5.00 GiB", "3000.00 PiB", "110.12 KiB", None]
    pairs = spark.createDataFrame([(0.2, 0.4), (0.0, 0.4), (0.2, 0.0)], "e double, a double")
    assert [r[0] for r in pairs.select(sl.psi("e", "a")).collect()] == [pytest.approx(0.2 * math.log(2)), None, None]
    names = spark.createDataFrame([("ipykernel -f /run/kernel-4af.json",), ("bash",)], "c string")
    assert [r[0] for r in names.select(sl.extract_id("c", r".+kernel-(.+)\.json")).collect()] == ["4af", "bash"]


def test_clean_text(spark):
    cells = ["NULL", "a&amp;b", "&lt;p&gt; &eacute; &#39;", "ﬁne ① ２", None, "plain", "&amp;amp;", "null"]
    df = spark.createDataFrame([(c, 1) for c in cells], "t string, n int")
    cleaned = sl.clean_columns(df)
    assert [r["t"] for r in cleaned.collect()] == ["", "a&b", "<p> é '", "fine 1 2", None, "plain", "&amp;", "null"]
    assert cleaned.dtypes == df.dtypes


@pytest.mark.parametrize(
    "name, expected",
    [
        ("INT", T.IntegerType()),
        (" bigint(20) ", T.LongType()),
        ("largeint", T.DecimalType(38, 0)),
        ("decimalv3(12, 4)", T.DecimalType(12, 4)),
        ("varchar(65533)", T.StringType()),
        ("varchar(*)", T.StringType()),
        ("jsonb", T.VariantType()),
        ("datev2", T.DateType()),
        ("datetime(3)", T.TimestampNTZType()),
        ("hll", T.BinaryType()),
        ("array<datev2>", T.ArrayType(T.DateType())),
        ("map<string, decimal(9,2)>", T.MapType(T.StringType(), T.DecimalType(9, 2))),
        ("struct<date:int, b:array<largeint>>", T.StructType([
            T.StructField("date", T.IntegerType()), T.StructField("b", T.ArrayType(T.DecimalType(38, 0)))])),
        ("geometry", T.NullType()),
        ("%", T.NullType()),
    ],
)
def test_parse_types(spark, name, expected):
    assert sl.parse_type(name) == expected


def test_cast_schema(spark):
    df = spark.createDataFrame([("12", '{"a": 1}', "x"), ("zz", "{", "y")], "n string, j string, o string")
    cast = sl.cast_schema(df, {"n": "smallint", "j": "json", "o": "geometry"})
    assert cast.dtypes == [("n", "smallint"), ("j", "variant"), ("o", "string")]
    rows = cast.select("n", F.variant_get("j", "$.a", "int").alias("a")).collect()
    assert [tuple(r) for r in rows] == [(12, 1), (None, None)]


def test_shrink_types(spark):
    data = [(127, 126, 32767, 40000, 2**31, 1.5, -127, None), (-5, 0, 0, 0, 0, math.nan, 0, None)]
    names = "b127 long, b126 long, s long, i long, l long, d double, n int, e int"
    df = spark.createDataFrame(data, names)
    shrunk = sl.shrink_types(df)
    assert [t for _, t in shrunk.dtypes] == ["smallint", "tinyint", "int", "int", "bigint", "double", "tinyint", "int"]
    assert [tuple(r)[:5] for r in shrunk.collect()] == [d[:5] for d in data]
    assert dict(sl.shrink_types(df, floats=True).dtypes)["d"] == "float"
    big = spark.createDataFrame([(1e300,)], "d double")
    assert sl.shrink_types(big, floats=True).dtypes == big.dtypes


def test_normalize_decimals(spark):
    D = decimal.Decimal
    df = spark.createDataFrame(
        [(D("1.00"), D("1.50"), D(10) ** 30, None)], "a decimal(9,2), b decimal(9,2), c decimal(38,0), d decimal(5,1)"
    )
    got = sl.normalize_decimals(df)
    assert [t for _, t in got.dtypes] == ["bigint", "double", "double", "bigint"]
    assert tuple(got.first()) == (1, 1.5, 1e30, None)


def test_nunique(spark):
    nan = math.nan
    df = spark.createDataFrame([(1.0, "a", nan), (1.0, None, nan), (2.0, "b", 5.0), (nan, "a", None)], "x double, s string, y double")
    assert {r["column_name"]: r["nunique"] for r in sl.nunique(df).collect()} == {"x": 3, "s": 3, "y": 4}
    assert {r["column_name"]: r["nunique"] for r in sl.nunique(df, approx=True).collect()} == {"x": 3, "s": 3, "y": 4}
    rows = spark.createDataFrame([(1.0, 1.0, 2.0), (nan, nan, 1.0), (None, 1.0, 1.0)], "a double, b double, c double")
    assert [r["nunique"] for r in sl.nunique(rows, axis=1).collect()] == [2, 3, 2]


def test_profile_and_sizes(spark):
    df = spark.createDataFrame(
        [(1, "añ", decimal.Decimal("1.5"), [1, 2], None), (1, None, None, None, {"k": 1})],
        "i int, s string, d decimal(10,2), a array<int>, m map<string,int>",
    )
    got = {r["column_name"]: r.asDict() for r in sl.column_profile(df).collect()}
    assert got["s"] | {"comment": 0} == {
        "column_name": "s", "comment": 0, "data_type": "string", "data_length": 3, "data_precision": None,
        "num_distinct": 1, "num_nulls": 1, "density": 1.0,
    }
    assert got["d"]["data_precision"] == 10 and got["m"]["num_distinct"] == 1 and got["i"]["data_length"] == 4
    assert {r["column_name"]: r["num_distinct"] for r in sl.column_profile(df, approx=True).collect()}["i"] == 1
    sizes = sl.column_sizes(df).collect()
    by_name = {r["column_name"]: r["bytes"] for r in sizes}
    assert (by_name["i"], by_name["s"], by_name["d"], by_name["a"]) == (8, 3, 8, 8)
    assert [r["bytes"] for r in sizes] == sorted((r["bytes"] for r in sizes), reverse=True)
    total = sl.result_size(df).first()
    assert (total["rows"], total["bytes"]) == (2, sum(by_name.values()))


def test_profile_of_long_text_and_of_nothing(spark):
    texts = ["x" * 64, "x" * 65, "x" * 65, "y" * 500, "y" * 501, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert sl.nunique(df).first()["nunique"] == 5
    row = sl.column_profile(df).first()
    assert (row["num_distinct"], row["num_nulls"], row["data_length"]) == (4, 1, 501)
    for approx in (False, True):
        empty = sl.column_profile(df.where("false"), approx).first()
        assert (empty["num_distinct"], empty["num_nulls"], empty["density"]) == (0, 0, None)


def test_documents(spark):
    turns = [(1, 0, "%py\nx = 1\n"), (1, 1, "  \n%sql\nselect 1"), (1, 10, "no mark"), (2, 0, "%md \n# title")]
    df = spark.createDataFrame(turns, "doc int, i int, t string").repartition(3)
    for size in (1, 10, None):
        whole = {r["doc"]: r["script"] for r in sl.assemble_documents(df, "doc", "i", "t", part_size=size).collect()}
        assert whole == {1: "#%py\nx = 1\n\n#%sql\nselect 1\nno mark", 2: "#%md \n# title"}


def test_inner_parts_change_nothing(spark):
    rows = [(1, i, f"%py\nx = {i}" if i % 4 else (None if i % 8 else f"no mark {i}\n%sql\ny")) for i in range(25)]
    rows += [(2, 0, "one paragraph\nof two lines"), (3, 5, None), (None, 1, "%md\na"), (None, 0, "b"), (4, None, "c"), (4, 1, "d")]
    df = spark.createDataFrame(rows, "doc int, i int, t string").repartition(4)
    found = []
    for size in (3, 10, None):
        scripts = sl.assemble_documents(df, "doc", "i", "t", part_size=size)
        assert scripts.columns == ["doc", "paragraphs", "script"]
        pieces = sl.split_documents(scripts, "doc", "script")
        found.append((sorted(map(tuple, scripts.collect()), key=repr), sorted(map(tuple, pieces.collect()), key=repr)))
    assert found[0] == found[1] == found[2]
    assert len(found[0][0]) == 5 and [r[1] for r in found[0][0] if r[0] == 1] == [25]
    numbers = [i for d, i, _ in found[0][1] if d == 1]
    assert sorted(numbers) == list(range(len(numbers)))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("no mark", ["%pyspark\nno mark"]),
        ("head\n#%py\nx\n##%sql\ny", ["%pyspark\nhead", "%py\nx", "%sql\ny"]),
        ("#%py\nx\n#%py\n\ny\n", ["#%py\nx", "%py\n\ny\n"]),
        ("head\n%py\nx\n%sql\ny", ["%pyspark\nhead", "%py\nx\n%sql\ny"]),
        ("head\n#%py code\nx", ["%pyspark\nhead\n#%py code\nx"]),
        ("\n#%py\nx", ["%py\nx"]),
        ("", []),
    ],
)
def test_split_documents(spark, text, expected):
    df = spark.createDataFrame([(7, text)], "doc int, t string")
    got = sorted(sl.split_documents(df, "doc", "t").collect(), key=lambda r: r["index"])
    assert [r["paragraph"] for r in got] == expected
    assert [r["index"] for r in got] == list(range(len(expected)))


def test_row_numbers_of_copies_and_cells(spark):
    rows = [(i % 5 if i % 3 else None, i % 7, "x" if i % 2 else None) for i in range(400)] + [(2, 2, "same")] * 300
    df = spark.createDataFrame(rows, "k int, v int, copies string").repartition(5)
    for size in (1, 10, 100, 10**6):
        got = sl.row_numbers(df, ["k", "v"], rows_per_cell=size).collect()
        assert sorted(r["row_number"] for r in got) == list(range(1, 701))
        by_number = [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["row_number"])]
        assert by_number == sorted(by_number, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(rows, key=repr)
    held = df.withColumn("m", F.create_map(F.lit("a"), F.col("v")))
    assert sorted(r["row_number"] for r in sl.row_numbers(held, ["k"], rows_per_cell=100).collect()) == list(range(1, 701))
    assert sl.row_numbers(df.limit(0), ["k"]).collect() == []


def test_row_numbers_by_text_and_by_a_join(spark):
    r = random.Random(4)
    left = spark.createDataFrame([(i, r.choice([None, "a", "b", "é"]) and f"{r.random():.2f}") for i in range(900)], "id int, t string").repartition(4)
    right = spark.createDataFrame([(i % 300, float(i)) for i in range(600)], "id int, x double")
    for size in (2, 40):
        got = sl.row_numbers(left.join(right, "id"), ["t", "x"], rows_per_cell=size).orderBy("row_number").collect()
        assert [g["row_number"] for g in got] == list(range(1, 601))
        order = [(g["t"] is not None, g["t"] or "", g["x"]) for g in got]
        assert order == sorted(order)


def test_distinct_values_per_row_of_any_type(spark):
    rows = [(2**53, 2**53 + 1, "a", "b"), (5, 5, "a", "a"), (None, 5, None, None)]
    df = spark.createDataFrame(rows, "a long, b long, s string, t string")
    assert [r["nunique"] for r in sl.nunique(df, ["a", "b"], axis=1).collect()] == [2, 1, 2]
    assert [r["nunique"] for r in sl.nunique(df, ["s", "t"], axis=1).collect()] == [2, 1, 2]
    assert [r["nunique"] for r in sl.nunique(df, ["a", "s"], axis=1).collect()] == [2, 2, 2]
    floats = spark.createDataFrame([(1.0, float("nan"), 1)], "x double, y double, z int")
    assert sl.nunique(floats, axis=1).first()["nunique"] == 2


def test_first_per_key_with_dots(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 9, "c")], ["t.k", "t.o", "t.v"])
    got = sl.first_per_key(df, ["t.k"], ["t.o"])
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, 1, "a"), (2, 9, "c")]


def test_distinct_counts_by_bitmap(spark, monkeypatch):
    """Whole numbers below, at and above 0, dates and booleans, in ranges of one bitmap and of several."""
    r = random.Random(6)
    rows = []
    for i in range(3000):
        values = (r.choice([0, 1, -1, 32768, 32769, -32768, -32767, None]), r.randrange(-70_000, 70_000), i % 2 == 0 if i % 3 else None,
                  None, r.randrange(10**6), f"t{r.randrange(50)}", r.choice([1.5, float("nan"), None, -0.0]))
        rows.append((*values, datetime.date(2020, 1, 1) + datetime.timedelta(days=r.randrange(900)), r.choice([-(2**63), 2**63 - 1, 5])))
    df = spark.createDataFrame(rows, "small int, wide int, flag boolean, nothing int, far long, t string, x double, day date, ends long").repartition(5)
    want = {}
    for k, c in enumerate(df.columns):
        cells = [row[k] for row in rows]
        missing = sum(v is None or v != v for v in cells)
        want[c] = len({v for v in cells if v is not None and v == v}) + missing
    for at_once in (8, 1):
        monkeypatch.setattr("scorelake.operators.profile.BITMAPS_AT_ONCE", at_once)
        assert {row["column_name"]: row["nunique"] for row in sl.nunique(df).collect()} == want
        profile = {row["column_name"]: row for row in sl.column_profile(df).collect()}
        assert profile["wide"]["data_length"] == 4 and profile["nothing"]["data_length"] is None and profile["nothing"]["num_distinct"] == 0
        assert profile["small"]["num_distinct"] == 7 and profile["day"]["num_distinct"] == want["day"]
    monkeypatch.setattr("scorelake.operators.profile.MERGE_GROUPS", 2)
    assert {row["column_name"]: row["nunique"] for row in sl.nunique(df.repartition(7)).collect()} == want
    assert {row["column_name"]: row["nunique"] for row in sl.nunique(df.limit(0)).collect()} == dict.fromkeys(df.columns, 0)


def test_distinct_counts_by_bitmap_over_a_wide_dense_range(spark, monkeypatch):
    monkeypatch.setattr("scorelake.operators.profile.BITMAPS_AT_ONCE", 1)
    df = spark.range(-50_000, 150_000).select(F.when(F.col("id") % 10 != 3, F.col("id")).alias("id"), (F.col("id") % 7).alias("k"))
    assert {r["column_name"]: r["nunique"] for r in sl.nunique(df).collect()} == {"id": 200_000, "k": 13}
    text = sl.nunique(df.repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in text


def test_stitched_slices_go_through_one_shuffle(spark):
    frames = [spark.range(50).select((F.col("id") * (i + 1)).alias("id"), F.lit(i).alias(f"c{i}")) for i in range(4)]
    wide = sl.stitch_columns(frames, "id")
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    rows = {r["id"]: r for r in wide.collect()}
    assert len(rows) == len({k * (i + 1) for k in range(50) for i in range(4)})
    assert all(rows[k][f"c{i}"] == (i if k % (i + 1) == 0 and k // (i + 1) < 50 else None) for k in rows for i in range(4))


def test_stitched_names_and_repeated_keys(spark):
    a = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0)], "id int, _key0 string, turn double")
    b = spark.createDataFrame([(2, 5, {"x": 1}), (3, 6, None)], "id int, slice int, v0 map<string,int>")
    wide = sl.stitch_columns([a, b], "id")
    assert wide.columns == ["id", "_key0", "turn", "slice", "v0"]
    got = [tuple(r) for r in wide.collect()]
    assert sorted((r[0], r[1]) for r in got if r[1]) == [(1, "a"), (2, "b"), (2, "c")]
    assert sorted((r[0], r[3]) for r in got if r[3]) == [(2, 5), (3, 6)] and len(got) == 4
    with pytest.raises(ValueError, match="slice"):
        sl.stitch_columns([b, b], "id")
    assert sl.stitch_columns([a], ["id", "turn"]).columns == ["id", "turn", "_key0"]


def test_pages_by_number(spark):
    rows = [(i * 7919 % 1000 // 3, f"t{i % 4}" if i % 9 else None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, cell string, i int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    for rows_per_cell in (3, 50, 10**6):
        index = sl.PageIndex(df, ["k", "cell", "i"], rows_per_cell)
        for number, size in ((0, 10), (3, 100), (9, 100), (10, 100), (1, 999), (0, 0)):
            assert [tuple(r) for r in index.page(number, size).collect()] == want[number * size : (number + 1) * size]
        assert index.page(2, 5).columns == df.columns
    assert sl.PageIndex(df.limit(0), ["k"]).page(0, 5).collect() == []
    with pytest.raises(ValueError):
        index.slice(-1, 5)
