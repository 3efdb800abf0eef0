import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorelake.llm.common import buffers
from scorelake.llm.rule_ensemble import STATISTICS, Ensemble, Rule, fit, lasso, scored, statistics, tree_rules, with_statistics


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = scored(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.93
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_held_out_labels_are_not_learned(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in scored(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in scored(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), turned).collect()}
    assert a == b


def test_edge_rows(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (4, 1), (4, 0), (None, 1), (99, 0)], "doc_id long, quality int")
    got = scored(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1
    assert scored(none, labels).collect() == []
    assert {r["score"] for r in scored(edge, labels.limit(0)).collect()} == {0.5}


def test_columns_equal_the_ensemble(spark, docs):
    texts = [r["text"] for r in docs.select("text").limit(50).collect()] + ["", " ", "a", "A!\n\n!"]
    data, offsets = buffers(pa.array(texts))
    x = statistics(data, offsets)
    assert np.isfinite(x).all() and x.shape == (len(texts), len(STATISTICS))
    one = np.concatenate([statistics(*buffers(pa.array([t]))) for t in texts])
    assert np.allclose(x, one)
    rng = np.random.default_rng(0)
    model = Ensemble(0.2, [(Rule(((j, bool(j % 2), float(np.median(x[:, j]))), (j + 1, False, 0.5))), float(rng.normal())) for j in range(10)], [(0, 0.3, 1.0, 5.0)])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", with_statistics(F.col("text")).alias("s"))
    got = {r["i"]: r["p"] for r in df.select("i", model.column(F.col("s")).alias("p")).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], model.score(x))


def test_rules_and_lasso():
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 7] <= 0.4)).astype(float)
    rules = tree_rules(x, y, 5)
    assert len(set(rules)) == len(rules) and all(1 <= len(r.terms) <= 3 for r in rules)
    model = fit(x, y)
    assert np.mean((model.score(x) >= 0.5) == y) > 0.97
    assert len(model.rules) < len(tree_rules(x, y)) / 2
    b, w = lasso(rng.random((500, 5)), np.ones(500) * 0.5, 0.5)
    assert (w == 0).all()
    assert fit(x[:0], y[:0]).score(x[:1]) == 0.5 and fit(x[:5], np.ones(5)).score(x[:1]) > 0.9
