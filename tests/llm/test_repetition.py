import random
import re

import numpy as np
import pytest

from scorelake.llm.repetition import SHORTEST, keep_quality, longest_repeats, quality_report, suffix_ranks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    grams = {}
    for i in range(n - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    marked = set()
    for places in grams.values():
        if len(places) > 1:
            for p in places:
                marked.update((p, p + 1, p + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    longest, covered = 0, set()
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= SHORTEST:
            covered.update(range(i, i + best))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = n < 50 or 100 * len(marked) > 50 * n
    kept = not failed and not 100 * len(covered) > 50 * n and not (longest > 100 and 100 * longest > 40 * n)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), len(covered), longest, failed, kept


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 30, 8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    words = rng.integers(0, 3, bounds[-1])
    ends = np.repeat(bounds[1:], sizes)
    order, prefix = suffix_ranks(words, ends)
    suffix = [tuple(words[i : ends[i]]) for i in range(len(words))]
    assert [suffix[i] for i in order] == sorted(suffix)
    for k in range(len(order) - 1):
        a, b = suffix[order[k]], suffix[order[k + 1]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix[k] == same
    assert len(longest_repeats(words.astype(np.uint64), bounds)) == len(words)


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "bé", "c#", "<d>", "e|f", "x", "\x1cy", " z"]
    out = [None, "", " \n\t", "a", "a a", "\n\n", "same line\nsame line\r\nsame line\n same line\n\n"]
    for _ in range(60):
        out.append("".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", " \n"]) for _ in range(rng.randint(0, 90))))
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(10):
        part = [rng.choice(vocabulary) for _ in range(60)]
        out.append(" ".join(part + [rng.choice(vocabulary) for _ in range(rng.randint(0, 90))] + part[: rng.randint(0, 60)]))
    return out


def test_against_brute_force(spark):
    rows = list(enumerate(texts(4)))
    got = {r[0]: tuple(r)[1:] for r in quality_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, text in rows:
        assert got[i] == brute(text), repr(text)


def test_edge_rows(edge, none, docs):
    assert quality_report(edge).count() == edge.count()
    assert quality_report(none).collect() == []
    assert keep_quality(none).columns == edge.columns
    clash = edge.withColumnRenamed("length", "quality")
    kept = keep_quality(clash)
    assert kept.columns == clash.columns and kept.collect() == []
    want = {r["doc_id"] for r in quality_report(docs).collect() if r["kept"]}
    assert {r["doc_id"] for r in keep_quality(docs).collect()} == want and want


def test_a_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(200_000)) + " same" * 5000
    got = quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got["n_words"] == 205_000 and got["longest_repeat"] == 4999
