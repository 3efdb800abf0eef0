import hashlib
import random

import numpy as np
import pytest

from scorelake.llm.suffix_dedup import SEGMENT, blind_trie, deep_shallow, merged, segments, stretches, without_repeats


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def some_strings(rng, n, letters=b"ab", longest=150):
    stem = bytes(rng.choice(letters) for _ in range(longest))
    return [stem[: rng.randint(0, longest)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_blind_trie(seed):
    rng = random.Random(seed)
    strings = list(dict.fromkeys(b"x" * 5 + s for s in some_strings(rng, 60)))
    order, depth = blind_trie(strings, 5)
    assert [strings[i] for i in order] == sorted(strings)
    assert depth[1:] == [shared(strings[a], strings[b]) for a, b in zip(order, order[1:])]


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow(seed):
    rng = random.Random(seed)
    strings = some_strings(rng, 200) + [b"", b"", b"a\0", b"a", b"a\0\0", b"\0" * 80, b"\0" * 81]
    group = np.array([rng.randint(0, 3) for _ in strings])
    order, depth = deep_shallow(strings, group)
    want = sorted(range(len(strings)), key=lambda i: (group[i], strings[i]))
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
    for k in range(1, len(order)):
        a, b = order[k - 1], order[k]
        assert depth[k] == (shared(strings[a], strings[b]) if group[a] == group[b] else 0)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 1000, dtype=np.uint8)
    other = np.concatenate([rng.integers(97, 100, 37, dtype=np.uint8), text[300:600], rng.integers(97, 100, 50, dtype=np.uint8)])
    seen = {}
    for data in (text, other):
        doc, begin, many, first, anchor, _ = stretches(data, np.array([0, len(data)]))
        assert many.sum() == len(data) - 199
        for b, m, f, h in zip(begin, many, first, anchor):
            for w in range(m):
                seen.setdefault(data[b + w : b + w + 200].tobytes(), set()).add((f - w, h))
    assert all(len(v) == 1 for v in seen.values())


def test_segments_of_a_very_long_text_hold_every_window_once():
    size = 2 * SEGMENT + 12_345
    data = np.resize(np.arange(251, dtype=np.uint8), size)
    seen = 0
    for doc, skip, part, bounds in segments(data, np.array([0, size]), 200):
        assert doc == 0 and skip == seen and (part == data[skip : skip + len(part)]).all()
        seen += len(part) - 199
    assert seen == size - 199


def brute(texts, window):
    raw = [(t or "").encode() for t in texts]
    count = {}
    for t in raw:
        for i in range(len(t) - window + 1):
            count[t[i : i + window]] = count.get(t[i : i + window], 0) + 1
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 2, np.int64)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i + 1] += 1
                gone[i + window + 1] -= 1
        gone = np.cumsum(gone)[1:-1] > 0 if len(t) else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1)
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, texts, ids=None, **limits):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    got = without_repeats(df, **limits).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    ours = sorted((tuple(r)[:5] for r in got), key=key)
    want = sorted(((i, *r) for i, r in zip(ids, brute(texts, limits.get("window", 200)))), key=key)
    assert ours == want


def passages(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared_ = [say(60) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [say(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared_)
            a, b = sorted(rng.sample(range(len(p)), 2))
            parts += [p[a:b] if rng.random() < 0.7 else p, say(rng.randint(0, 20))]
        texts.append(rng.choice(["", " "]).join(parts))
    return texts + [texts[0], texts[1], texts[1] + "x", "ab" * 400, "ab" * 300, None, "", "z" * 199, "z" * 200, "y" * 201, *shared_]


def test_against_brute_force(spark):
    compare(spark, passages(1, 60))


@pytest.mark.parametrize("together", [1, 2, 5])
def test_hot_groups_are_split(spark, together):
    compare(spark, passages(2, 80), together=together)


def test_cells_sort_what_differs(spark):
    rng = random.Random(9)
    stem = "".join(rng.choice("abc") for _ in range(420))
    texts = []
    for _ in range(40):
        a = rng.randrange(150, 260)
        texts.append(stem[:a] + rng.choice("xyz") + stem[a + 1 :])
    compare(spark, texts, together=3)


def test_repeated_ids_and_rows(spark):
    texts = passages(3, 10)
    ids = [1, 1, 2, 2, None] + list(range(5, len(texts)))
    compare(spark, texts + [texts[0]], ids + [1])


def test_edge_rows(edge, none, spark):
    rows = edge.collect()
    compare(spark, [r["text"] for r in rows], [r["doc_id"] for r in rows])
    assert without_repeats(none).collect() == []
    assert without_repeats(edge).count() == len(rows)


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_rows_that_repeat_very_often(spark):
    """Whatever the number of equal rows, one stands for all; its spans are found once."""
    texts = passages(6, 6)
    long = max(texts, key=lambda t: len(t or ""))
    for n in (3, 300):
        compare(spark, [*texts, *[long] * n, *["short"] * n, *[None] * n], [*range(len(texts)), *[77] * n, *[78] * n, *[None] * n])
    rows = spark.createDataFrame([(1, "m", long)] * 2000, "doc_id long, extra string, text string").repartition(8)
    got = without_repeats(rows.select("doc_id", "text")).collect()
    assert len(got) == 2000 and all(r["n_removed"] == r["n_bytes"] == len(long.encode()) and len(r["spans"]) == 1 for r in got)
