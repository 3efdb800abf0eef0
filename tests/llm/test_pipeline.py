import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorelake.llm.common import stored
from scorelake.llm.packing import cut

from .test_contamination import brute as leaks
from .test_line_templates import brute as lines
from .test_repetition import brute as quality
from .test_similar_texts import brute as similar
from .test_tokens import ids_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_every_stage_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        if name == "quality_rules":
            want = {d: t for d, t in want.items() if quality(t)[-1]}
        elif name == "line_dedup":
            want = {r[0]: r[1] for r in lines(list(want.items()))}
        elif name == "near_dedup":
            stay = set(similar(list(want.items())))
            want = {d: t for d, t in want.items() if d in stay}
        elif name == "decontamination":
            gone = {r[0] for r in leaks(list(want.items()), items)}
            want = {d: t for d, t in want.items() if d not in gone}
        if name != "packing":
            assert docs.columns == names
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    pieces = sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in docs.collect())
    assert pieces == sorted((d, k, s, n) for d, t in want.items() for k, (s, n) in enumerate(cut(len(ids_of(t)), 1024)))
    run = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in run.collect()) == pieces


def test_edge_rows(spark, edge, none, folder, tmp_path):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    for df, name in ((edge, "edge"), (none, "none")):
        d = str(tmp_path / name)
        df.withColumn("dropped", F.lit(1)).write.parquet(f"{d}/documents.parquet")
        benchmark.write.parquet(f"{d}/benchmark.parquet")
        # All edge texts are too short or repeat themselves.
        assert corpus_pipeline.run(spark, d).collect() == []


#: Names of columns that the stages use inside.
INNER = ("_id", "_mark", "_digest", "kept_id", "kept_digest", "dropped_id", "dropped_mark", "dropped_lines", "_items", "quality", "root", "fp",
         "mark", "keys", "row", "entry", "least", "class", "n", "id", "digest", "template", "piece", "start", "item")


def test_columns_with_inner_names_stay_as_they_are(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = clashing = docs
    for i, name in enumerate(INNER):
        clashing = clashing.withColumn(name, F.concat(F.lit(f"{i} "), "doc_id"))
    for name, stage in corpus_pipeline.STAGES:
        plain, clashing = stored(stage(spark, plain, folder), name), stored(stage(spark, clashing, folder), name)
        if name == "packing":
            assert sorted(map(tuple, plain.drop("sequence_id", "offset").collect())) == sorted(map(tuple, clashing.drop("sequence_id", "offset").collect()))
        else:
            assert clashing.columns == [*plain.columns, *INNER]
            assert sorted(r["doc_id"] for r in plain.collect()) == sorted(r["doc_id"] for r in clashing.collect())
            assert all(r[c] == f"{i} {r['doc_id']}" for r in clashing.collect() for i, c in enumerate(INNER))
