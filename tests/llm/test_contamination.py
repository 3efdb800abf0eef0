import random
import re
from collections import Counter

import numpy as np

from scorelake.llm.contamination import Index, blocks, contaminated, drop_contaminated, shingles, signs, simhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def grams(w, size):
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(docs, items):
    out = []
    targets = [(i, words(t)) for i, t in items]
    for doc_id, text in docs:
        own = words(text)
        have = {k: set(grams(own, k)) for k in range(1, 6)}
        for item_id, other in targets:
            n, size = len(other), min(5, len(other))
            if not n or len(own) < size or item_id is None:
                continue
            target, best = grams(other, size), (0, 0)
            if have[size].isdisjoint(target):
                continue  # no window shares anything
            for a in range(max(1, len(own) - n + 1)):
                mine = grams(own[a : a + n], size)
                s = sum((mine & target).values()) / sum((mine | target).values())
                if s > best[0]:
                    best = (s, a)
            if best[0] >= 0.8:
                out.append((doc_id, item_id, best[1], min(n, len(own)), round(best[0], 9)))
    return out


def found(df):
    return sorted(((*r[:4], round(r[4], 9)) for r in map(tuple, df.collect())), key=repr)


def case(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "the"]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [say(rng.randint(5, 60)) for _ in range(12)] + [say(k) for k in (1, 2, 3, 4)] + [["a", "b"] * 12, []]
    items[-3] = ["only", "these", "four", "words"]
    docs = []
    for _ in range(n):
        part = list(rng.choice(items[:12]))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(part))
            change = rng.random()
            part[at : at + 1] = [rng.choice(vocabulary)] if change < 0.6 else ([] if change < 0.8 else [part[at], "new"])
            part = part or ["x"]
        sep = rng.choice([" ", ", ", "\n"])
        docs.append(sep.join(say(rng.randint(0, 80)) + [w.upper() if rng.random() < 0.3 else w for w in part] + say(rng.randint(0, 80))))
    docs += [" ".join(["a", "b"] * 20), None, "", "only these four words", " ".join(items[0][1:]), " ".join(items[1])]
    return [(i, t) for i, t in enumerate(docs)], [(i, " ".join(t)) for i, t in enumerate(items)] + [(99, " ".join(items[0])), (None, "null id item of words"), (98, None)]


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs, items = case(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        b = spark.createDataFrame(items, "item_id long, text string")
        want = sorted(brute(docs, items), key=repr)
        assert found(contaminated(d, b)) == want
        # A benchmark beyond the bound is searched part by part, with the same result.
        assert found(contaminated(d, b, part_bytes=700)) == want
        kept = {r["doc_id"] for r in drop_contaminated(d, b, part_bytes=700).collect()}
        assert kept == {i for i, _ in docs} - {r[0] for r in brute(docs, [(i or 0, t) for i, t in items])}


def test_documents(spark, docs):
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows, [(r["item_id"], r["text"]) for r in b.collect()])
    assert found(contaminated(docs, b)) == sorted(want, key=repr) and want


def test_edge_rows(spark, edge, none):
    b = spark.createDataFrame([(1, "the same row twice"), (1, "the same row twice"), (2, "word " * 20)], "item_id long, text string")
    assert {r["doc_id"] for r in contaminated(edge, b).collect()} == {4, 5, 6}
    assert contaminated(none, b).collect() == [] and contaminated(edge, b.limit(0)).collect() == []
    kept = drop_contaminated(edge, b)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 4
    assert drop_contaminated(edge, b.limit(0)).count() == edge.count()


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(5)
    assert sum(w for _, w in blocks()) == 64
    for _ in range(500):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        y = x
        for b in rng.choice(64, 24, replace=False):
            y ^= 1 << int(b)
        assert any(x >> s & (1 << w) - 1 == y >> s & (1 << w) - 1 for s, w in blocks())


def test_similar_windows_are_within_the_radius():
    rng = np.random.default_rng(6)
    far = []
    for _ in range(300):
        item = rng.integers(0, 2**63, rng.integers(14, 60)).astype(np.uint64)
        other = item.copy()
        n = len(item) - 4
        # One or two changed words, as far as the similarity allows.
        for _ in range(max(1, int(n * 0.1) // 5)):
            other[rng.integers(0, 2) * -1] = np.uint64(rng.integers(0, 2**63))
        a, b = shingles(item, 5), shingles(other, 5)
        marks = simhash(np.stack([signs(a).sum(axis=0), signs(b).sum(axis=0)]))
        far.append(int(marks[0] ^ marks[1]).bit_count())
    assert max(far) <= 24


def test_index_of_nothing():
    assert Index([]).matches(np.zeros(0, np.uint8), np.zeros(3, np.int64)) == [[], []]
