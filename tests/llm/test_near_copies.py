import random
import re

import pytest
import xxhash

from scorelake.llm.common import stored
from scorelake.llm.near_copies import balls, components, first_of_groups, links, near_copies, with_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keep_one(docs):
    return first_of_groups(docs, with_groups(docs.select("doc_id", "text")))


def mark(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks):
    """The least of the group of each different mark, by comparing all."""
    todo, out = set(marks), {}
    while todo:
        front, group = [todo.pop()], set()
        while front:
            x = front.pop()
            group.add(x)
            near = {y for y in todo if (x ^ y).bit_count() <= 2}
            todo -= near
            front += near
        for x in group:
            out[x] = frozenset(group)
    return out


def check(df):
    rows = df.select("doc_id", "text").collect()
    marks = [mark(r["text"]) for r in rows]
    group = groups(marks)
    least = {}
    for r, m in zip(rows, marks):
        if r["doc_id"] is not None:
            least[group[m]] = min(least.get(group[m], r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{m:016x}", least.get(group[m])) for r, m in zip(rows, marks)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, near_copies(df).collect()), key=key) == sorted(want, key=key)
    return group, marks


def test_documents(docs):
    check(docs)


def test_edge_rows(edge, none, spark):
    check(edge)
    assert near_copies(none).collect() == []
    assert keep_one(none).columns == edge.columns
    kept = keep_one(edge).collect()
    group, marks = check(edge)
    assert len(kept) == len(set(group[m] for m in marks))
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 2, 4, 4, 6, 8]


def test_one_of_each_group_stays(docs):
    group, marks = check(docs)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group[m] for m in marks))


def test_links_and_components(spark):
    rng = random.Random(7)
    marks = {0, -1}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            marks.add(x - (1 << 64) if x >> 63 else x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    df = spark.createDataFrame([(m,) for m in marks], "fp long").repartition(4)
    want = groups([m & (2**64 - 1) for m in marks])
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    # All entries small, some hot, all hot.
    for together in (64, 3, 0):
        found = links(df, together=together)
        assert all(bin((r["fp"] ^ r["least"]) & (2**64 - 1)).count("1") <= 2 and r["fp"] != r["least"] for r in found.collect())
        roots = {r["fp"]: r["root"] for r in components(found).collect()}
        for m in marks:
            assert roots.get(m, m) == min(map(signed, want[m & (2**64 - 1)]))


def test_exploded_frames_are_not_broadcast(spark, monkeypatch):
    """Spark sizes them as before the explode, so that 34 times as much would go through the driver."""
    plans = []

    def noted(df, name, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name, *args)

    monkeypatch.setattr("scorelake.llm.near_copies.stored", noted)
    rng = random.Random(13)
    df = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(300)], "fp long")
    links(stored(df, "values"))
    joined = [p for p in plans if "Join" in p]
    assert len(joined) == 2 and all("Generate" in p and "SortMergeJoin" in p and "Broadcast" not in p for p in joined)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_balls_reach_every_value_within_the_radius(radius):
    rng = random.Random(radius)
    first, second = map(set, balls(radius))
    for _ in range(300):
        x = 0
        for b in rng.sample(range(64), rng.randint(0, radius)):
            x |= 1 << b
        low, high = x & (2**32 - 1), x >> 32 << 32
        assert low in first or (high - (1 << 64) if high >> 63 else high) in second
    assert len(first) + len(second) == {0: 1, 1: 2, 2: 34, 3: 66, 5: 1058}[radius]


def test_a_long_chain(spark):
    edges = [(i + 1, i) for i in range(300)]
    got = components(spark.createDataFrame(edges, "fp long, least long").repartition(5)).collect()
    assert {r["fp"]: r["root"] for r in got} == {i: 0 for i in range(301)}
