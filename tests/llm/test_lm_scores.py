import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from scorelake.llm.attention import Model, Trainer
from scorelake.llm import lm_scores
from scorelake.llm.lm_scores import PAD, is_held_out, scored_texts, subwords, train_on, windows_of, word_numbers
from scorelake.llm.tokens import tokenizer_path

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    out, word = [], ""
    for c in (text or "").translate(LETTERS):
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def check_base(got, rows):
    tokens = [(d, words_of(t) + [None]) for d, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    counts = Counter(t for (_, ts), h in zip(tokens, held) if not h for t in ts)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (d is None, d or 0, h, len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        for (d, ts), h in zip(tokens, held)
    )
    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    assert len(want) == len(have)
    for a, b in zip(want, have):
        assert a[:6] == b[:6] and math.isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = scored_texts(docs, every=1).collect()
    check_base(got, rows)
    # Better than words by themselves, and than subwords by themselves, on what it has not seen.
    size = subwords(tokenizer_path()).tokenizer.get_vocab_size()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids for d, t in rows}
    counts = np.zeros(size)
    for d, _ in rows:
        if not is_held_out(d):
            np.add.at(counts, [*ids[d], size - 1], 1)
    logs = np.log10((counts + 1) / (counts + 1).sum())
    held = [r for r in got if r["held_out"]]
    alone = sum(logs[[*ids[r["doc_id"]], size - 1]].sum() for r in held)
    assert sum(r["score"] for r in held) > 0.95 * alone
    # Untrained, the model is that distribution.
    plain = scored_texts(docs, every=1, rounds=0).collect()
    assert all(math.isclose(r["score"], logs[[*ids[r["doc_id"]], size - 1]].sum(), rel_tol=1e-4) for r in plain)


def test_all_but_few_words_enter_the_join(docs, monkeypatch):
    monkeypatch.setattr("scorelake.llm.lm_scores.COMMON", 5)
    check_base(scored_texts(docs, rounds=0).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(edge, none):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = scored_texts(edge).collect()
    check_base(got, rows)
    one, other = (r["score"] for r in got if r["doc_id"] in (2, 3))
    assert math.isclose(one, other, rel_tol=1e-5)
    assert scored_texts(none).collect() == []


def test_only_held_out_rows(spark):
    held = [d for d in range(60) if is_held_out(d)]
    rows = [(d, "some words here") for d in held]
    check_base(scored_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_results_do_not_depend_on_partitions(docs):
    part = docs.limit(60).cache()
    one, other = ({r["doc_id"]: r for r in scored_texts(part.repartition(k, "doc_id"), every=2).collect()} for k in (2, 5))
    assert all(math.isclose(one[d]["base_score"], other[d]["base_score"], rel_tol=1e-12) for d in one)
    assert all(math.isclose(one[d]["score"], other[d]["score"], rel_tol=1e-3) for d in one)


@pytest.mark.parametrize("texts", [["A b  a", None, "", "b C\tb"], [None], []])
def test_word_numbers(texts):
    import pyarrow as pa

    from scorelake.llm.common import buffers

    words, uses, bounds = word_numbers(*buffers(pa.array(texts, pa.string())))
    names = words.to_pylist()
    assert [[names[u] for u in uses[i:j]] for i, j in zip(bounds, bounds[1:])] == [words_of(t) for t in texts]


def test_windows_of_several_texts_train_alike():
    counts = np.arange(1, 60)
    model = Model(counts, 58)
    windows = np.random.default_rng(2).integers(0, 58, (10, 3 * model.stride))
    windows[:4, : model.stride] = -1
    before = {k: v.copy() for k, v in model.weights.items()}
    train_on(model, windows, Trainer(model))
    assert any((before[k] != model.weights[k]).any() for k in before)


def test_every_window_of_training_texts_is_trained_on(spark, monkeypatch):
    """Whatever its document or place: as many targets as there are subwords and ends, in the windows a text is cut into."""
    texts = ["", None, "a", "one two three", " ".join(f"word{i}" for i in range(900)), "x " * 127 + "y", "again", "again"]
    rows = [(d, t) for d, t in zip([0, 1, 2, 3, None, 5, 6, 6], texts)] + [(d, "held out " * 9) for d in range(40) if is_held_out(d)]
    seen = []
    monkeypatch.setattr(lm_scores, "train", lambda model, windows, rounds: seen.append((model, windows.collect())) or model)
    scored_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    model, runs = seen[0]
    known = subwords(tokenizer_path()).tokenizer
    want = []
    for d, t in rows:
        if not is_held_out(d):
            ids = known.encode(t or "", add_special_tokens=False).ids
            inputs, targets, _ = model.strides(np.array(ids, np.int64), np.array([0, len(ids)]))
            before = np.concatenate([np.full((1, model.stride), PAD), inputs[:-1]])
            want += np.concatenate([before, inputs, targets], axis=1).tolist()
    got = [w for r in runs for w in windows_of(np.frombuffer(r["run"], np.uint16), r["follows"], model).tolist()]
    assert len(want) > 64 and sorted(got) == sorted(want)


def test_windows_in_a_row_train_as_windows_apart():
    """Shared strides change nothing but the order of summation."""
    model, other = (Model(np.arange(1, 60), 58) for _ in range(2))
    windows = windows_of(np.random.default_rng(4).integers(0, 58, 150), False, model)
    assert (windows[1:, : model.stride] == windows[:-1, model.stride : 2 * model.stride]).all()
    train_on(model, windows, Trainer(model))
    train_on(other, np.concatenate([windows[::2], windows[1::2]]), Trainer(other))
    assert all(np.allclose(model.weights[k], other.weights[k], rtol=1e-3, atol=1e-4) for k in model.weights)
