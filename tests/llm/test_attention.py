import tracemalloc

import numpy as np
import pytest

from scorelake.llm.attention import PAD, Model, Trainer, classes_of, sorted_places


def small(dtype=np.float64, size=37, stride=4, seed=1):
    rng = np.random.default_rng(seed)
    model = Model(rng.integers(0, 50, size), size - 1, 6, 5, stride, dtype)
    for name, w in model.weights.items():
        model.weights[name] = rng.normal(size=w.shape).astype(dtype) * 0.4
    return model, rng


def plain(model, ids):
    """Log-probabilities of a text's ids and its end, token by token and over the whole vocabulary."""
    w, s, end = model.weights, model.stride, model.end
    width = w["out"].shape[0]
    inputs, targets, out = [end, *ids], [*ids, end], []
    for t, goal in enumerate(targets):
        begin = max(0, (t // s - 1) * s)
        x = w["ids"][inputs[begin : t + 1]]
        q, k, v = np.split(x @ w["qkv"], 3, axis=1)
        scores = q[-1] @ k.T / np.sqrt(width) + w["distance"][[t - j for j in range(begin, t + 1)]]
        a = np.exp(scores - scores.max())
        h = x[-1] + a / a.sum() @ v @ w["out"]
        z = h + np.maximum(h @ w["up"] + w["bias"], 0) @ w["down"]
        of_class = np.exp(z @ w["classes"] + model.class_bias)
        p = np.zeros(model.size)
        for c, (i, j) in enumerate(zip(model.starts, model.starts[1:])):
            inside = np.exp(w["places"][i:j] @ z + model.id_bias[i:j])
            p[model.order[i:j]] = of_class[c] / of_class.sum() * inside / inside.sum()
        assert np.isclose(p.sum(), 1)
        out.append(np.log(p[goal]))
    return out


def texts(rng, size, lengths):
    ids = rng.integers(0, size, sum(lengths))
    return ids, np.concatenate([[0], np.cumsum(lengths)])


def test_every_token_is_scored_once_in_its_window():
    model, rng = small()
    lengths = [0, 1, 3, 4, 5, 7, 8, 9, 30, 0, 2]
    ids, bounds = texts(rng, 37, lengths)
    inputs, targets, text = model.strides(ids, bounds)
    assert (targets != PAD).sum() == len(ids) + len(lengths)
    got = model.log_probs(inputs, targets, text).sum(axis=1)
    for i in range(len(lengths)):
        assert np.isclose(got[text == i].sum(), sum(plain(model, ids[bounds[i] : bounds[i + 1]].tolist())))


def test_texts_longer_than_a_pass(monkeypatch):
    model, rng = small()
    ids, bounds = texts(rng, 37, [300, 0, 61])
    inputs, targets, text = model.strides(ids, bounds)
    whole = model.log_probs(inputs, targets, text)
    monkeypatch.setattr("scorelake.llm.attention.PASS", 3)
    monkeypatch.setattr("scorelake.llm.attention.CHUNK", 7)
    follows = np.concatenate([[False], text[1:] == text[:-1]])
    total, gradients = model.gradients(inputs, targets, follows)
    monkeypatch.setattr("scorelake.llm.attention.LOGITS", 11)
    assert np.allclose(whole, model.log_probs(inputs, targets, text))
    again, parts = model.gradients(inputs, targets, follows)
    assert np.isclose(total, again) and (parts["places"][0] == gradients["places"][0]).all() and np.allclose(parts["places"][1], gradients["places"][1])


def test_an_untrained_model_is_the_distribution_of_ids():
    counts = np.array([5, 0, 90, 3, 1, 0, 1])
    model = Model(counts, 6)
    inputs, targets, text = model.strides(np.array([2, 1, 0]), np.array([0, 3]))
    got = np.exp(model.log_probs(inputs, targets, text)[0, :4])
    assert np.allclose(got, (counts[[2, 1, 0, 6]] + 1) / (counts + 1).sum(), rtol=1e-5)


@pytest.mark.parametrize("step", [1, 2])
@pytest.mark.parametrize("name", ["ids", "qkv", "out", "distance", "up", "bias", "down", "classes", "places"])
def test_gradients(name, step):
    model, rng = small(seed=3)
    ids, bounds = texts(rng, 37, [9, 2, 14])
    inputs, targets, text = model.strides(ids, bounds)
    follows = np.concatenate([[False], text[1:] == text[:-1]])
    _, gradients = model.gradients(inputs, targets, follows, step)
    g = gradients[name]
    if isinstance(g, tuple):
        g = np.zeros_like(model.weights[name])
        g[gradients[name][0]] = gradients[name][1]
    w = model.weights[name]
    for _ in range(12):
        at = tuple(rng.integers(0, n) for n in w.shape)
        if name == "ids":
            at = (int(rng.choice(inputs.reshape(-1))), at[1])
        old, values = w[at], []
        for change in (1e-5, -1e-5):
            w[at] = old + change
            values.append(model.gradients(inputs, targets, follows, step)[0])
        w[at] = old
        assert np.isclose(g[at], (values[0] - values[1]) / 2e-5, rtol=1e-4, atol=1e-6)


def test_training_learns_what_follows_what():
    rng = np.random.default_rng(0)
    ids = np.concatenate([(np.arange(40) * 3 + rng.integers(0, 20)) % 20 for _ in range(200)])
    bounds = np.arange(0, len(ids) + 1, 40)
    model = Model(np.bincount(ids, minlength=21), 20)
    inputs, targets, text = model.strides(ids, bounds)
    follows = np.concatenate([[False], text[1:] == text[:-1]])
    before = model.log_probs(inputs, targets, text).sum()
    trainer = Trainer(model)
    for _ in range(30):
        trainer.step(inputs, targets, follows)
    after = model.log_probs(inputs, targets, text).sum()
    assert after > before / 4


def test_classes_hold_every_id_once():
    for counts in (np.zeros(1, int), np.ones(10, int), np.arange(1000) ** 2):
        order, starts = classes_of(counts)
        assert sorted(order.tolist()) == list(range(len(counts))) and starts[0] == 0 and starts[-1] == len(counts) and (np.diff(starts) > 0).all()


def test_large_logits():
    model, rng = small(np.float32, seed=5)
    model.weights["classes"] *= 1000
    model.weights["qkv"] *= 100
    ids, bounds = texts(rng, 37, [9, 30])
    got = model.log_probs(*model.strides(ids, bounds))
    assert np.isfinite(got).all() and (got <= 1e-4).all()
    total, gradients = model.gradients(*model.strides(ids, bounds)[:2], np.array([0, 1, 1] + [0] + [1] * 7, bool))
    assert np.isfinite(total) and all(np.isfinite(g[1] if isinstance(g, tuple) else g).all() for g in gradients.values())


@pytest.mark.parametrize("size", [1 << 16, (1 << 16) + 1])
def test_equal_numbers_keep_their_order(size):
    numbers = np.random.default_rng(6).integers(size - 40, size, 500)
    assert sorted_places(numbers, size).tolist() == sorted(range(500), key=lambda i: numbers[i])


def test_gradients_go_by_passes(monkeypatch):
    """What the way back through attention needs besides its results does not grow with the step."""
    model, rng = small(np.float32, size=300, stride=16)
    ids, bounds = texts(rng, 300, [16 * 1024 - 1])
    inputs, targets, _ = model.strides(ids, bounds)
    follows = np.ones(len(inputs), bool)
    tracemalloc.start()
    total, gradients = model.gradients(inputs, targets, follows)
    peak = tracemalloc.get_traced_memory()[1]
    monkeypatch.setattr("scorelake.llm.attention.PASS", len(inputs))
    tracemalloc.reset_peak()
    again, others = model.gradients(inputs, targets, follows)
    assert peak < 0.9 * tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isclose(total, again)
    assert all(np.allclose(gradients[k][1], others[k][1]) if k in ("ids", "places") else np.allclose(gradients[k], others[k]) for k in gradients)
