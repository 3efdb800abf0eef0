import itertools
import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from scorelake.llm.common import buffers
from scorelake.llm.near_copies import near_copies
from scorelake.llm.similar_texts import bands, keep_one_similar, undecided_pairs

from .test_near_copies import LOWER, WORD


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b):
    return a == b or len(a & b) / len(a | b) >= 0.8


def brute(rows):
    """The ids that stay, by comparing all."""
    sets, group = {d: grams(t) for d, t in rows}, {d: d for d, _ in rows}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        if alike(sets[a], sets[b]):
            x, y = sorted((top(a), top(b)))
            group[y] = x
    return sorted({top(d) for d in group})


def family(rng, n):
    """Texts of a common stem with up to a twentieth of their words changed, some copies of copies."""
    out = [[f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 300))]]
    while len(out) < n:
        words = list(rng.choice(out))
        for _ in range(rng.randint(0, len(words) // 20)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(5000)}"
        out.append(words[: rng.randint(len(words) * 9 // 10, len(words))])
    return [" ".join(w) for w in out]


def test_edited_copies_against_brute_force(spark):
    rng = random.Random(3)
    texts = [t for _ in range(15) for t in family(rng, 12)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert 15 <= len(want) < 120
    assert sorted(r["doc_id"] for r in keep_one_similar(df).collect()) == want


def test_the_stage_drops_an_edited_copy(spark):
    words = [f"word{i}" for i in range(200)]
    edited = [*words[:50], "other", *words[51:150], "more", *words[151:]]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[:100] + [f"own{i}" for i in range(100)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [1, 3]


def test_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in keep_one_similar(docs).collect()) == brute(rows)


def test_edge_rows(edge, none):
    assert keep_one_similar(none).collect() == []
    kept = keep_one_similar(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 4, 4, 6, 8]


def test_pairs_at_the_limit_share_a_band():
    rng = random.Random(5)
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(1004)]
        keys = bands(*buffers(pa.array([" ".join(words[:904]), " ".join(words[100:])])))
        assert (keys[0, 1:] == keys[1, 1:]).any()
    assert not bands(*buffers(pa.array(["", None, " \n"]))).any()
    assert len(np.unique(bands(*buffers(pa.array(["a b", "b a", "a b c"])))[:, 0])) == 3


def test_own_edits_leave_nothing_to_compare(spark):
    """Copies edited each in its own way, alike to the stem or not, and pairs that are alike among themselves only."""
    rng = random.Random(8)
    stem, texts = [f"w{i}" for i in range(200)], []
    for i in range(120):
        words = list(stem)
        for k in rng.sample(range(200), 3 + i % 8):
            words[k] = f"own{i}x{k}"
        texts.append(" ".join(words))
        if i % 10 == 0:
            words[-1] = "end"
            texts.append(" ".join(words))
    sets = [grams(t) for t in texts]
    number = {g: n for n, g in enumerate(sorted(set().union(*sets)))}
    rows = [(i, [number[g] for g in s]) for i, s in enumerate(sets)]
    placed = spark.createDataFrame([(e, i, i) for i in range(len(texts)) for e in (1, 2)], "entry long, fp long, root long")
    found = {(r["least"], r["fp"]) for r in undecided_pairs(placed, spark.createDataFrame(rows, "fp long, grams array<long>")).collect()}
    want = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if alike(sets[a], sets[b])}
    assert want and want <= found
    assert len(found) < len(texts) ** 2 / 8


def test_a_large_group_against_brute_force(spark):
    rng = random.Random(9)
    texts = family(rng, 150)
    stem = [f"s{i}" for i in range(80)]
    for i in range(150):
        words = list(stem)
        for k in rng.sample(range(80), rng.randint(0, 5)):
            words[k] = f"e{rng.randrange(60)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    kept = keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(r["doc_id"] for r in kept.collect()) == brute(rows)


def test_the_stage_compares_near_copies_by_fingerprint(spark, monkeypatch):
    """Fingerprints within two bits meet, whatever the bands say, and are checked like all others."""
    rng = random.Random(12)
    rows = []
    for k in range(6):
        words = [f"g{k}x{i}" for i in range(600)]
        for _ in range(4):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(600)] = f"own{len(rows)}"
    # Near copies by their repeated shingles, but not alike.
    rows += [(len(rows) + i, "one two three " * 300 + " ".join(f"t{i}y{j}" for j in range(8))) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    groups = {r["doc_id"]: r["component_id"] for r in near_copies(df).collect()}
    assert 2 < len(set(groups.values())) < 20 and groups[24] == groups[25]
    sets = {d: grams(t) for d, t in rows}
    want, top = [], {d: d for d in sets}
    for a, b in itertools.combinations(sets, 2):
        if groups[a] == groups[b] and alike(sets[a], sets[b]):
            old, new = sorted((top[a], top[b]))[::-1]
            top = {d: new if t == old else t for d, t in top.items()}
    want = sorted({*top.values()})
    assert {24, 25} < set(want) and len(want) < 20

    def apart(data, offsets):
        """No two texts share a band."""
        mark = bands(data, offsets)[:, :1]
        return np.concatenate([mark, mark + np.arange(1, 33, dtype=np.uint64)], axis=1)

    monkeypatch.setattr("scorelake.llm.similar_texts.bands", apart)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == want
