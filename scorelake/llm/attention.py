"""A small causal self-attention language model over subword ids, trained and run in numpy.

A text is cut into strides; a window is a stride and the one before it, so windows
overlap by half and every token is scored once, in the window whose last stride holds
it, with one stride of context at least (except at the beginning of a text). Many windows are one batch
of masked attention. A ReLU layer follows, and the next id is predicted in two steps, its class and its
place in the class. Classes hold equal sums of the square roots of counts, so frequent ids are in small
classes. The logarithms of the counts are fixed summands: without training, the
model is the distribution of ids in the corpus.
"""

from __future__ import annotations

import numpy as np

STRIDE = 16
WIDTH, HIDDEN = 16, 16
#: Strides in one pass of attention, and in one pass over classes.
PASS, CHUNK = 128, 2048
#: Numbers in one softmax over the places of a class.
LOGITS = 1 << 21
PAD = -1


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids in order of their classes, and where each class begins, with the end of the last.

    Of several numbers of classes the one is taken that makes the two softmaxes of a token least work.
    """
    order = np.argsort(-counts, kind="stable")
    mass = counts[order] + 1.0
    share = np.cumsum(np.sqrt(mass))
    best = None
    for many in {min(1 << i, len(counts)) for i in range(4, 10)}:
        number = np.minimum((share / share[-1] * many).astype(np.int64), many - 1)
        starts = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(counts))
        work = len(starts) - 1 + (mass * np.repeat(np.diff(starts), np.diff(starts))).sum() / mass.sum()
        if best is None or (work, many) < best[:2]:
            best = (work, many, starts)
    return order, best[2]


class Model:
    """Parameters of the model for ids 0 to len(counts) - 1, of which ``end`` begins and ends every text."""

    def __init__(self, counts: np.ndarray, end: int, width: int = WIDTH, hidden: int = HIDDEN, stride: int = STRIDE, dtype=np.float32):
        self.stride, self.end, self.size = stride, end, len(counts)
        self.order, self.starts = classes_of(counts)
        self.place = np.empty(self.size, np.int64)
        self.place[self.order] = np.arange(self.size)
        self.kind = np.searchsorted(self.starts, self.place, "right") - 1
        mass = counts[self.order] + 1.0
        sums = np.add.reduceat(mass, self.starts[:-1])
        self.class_bias = np.log(sums / sums.sum()).astype(dtype)
        self.id_bias = np.log(mass / np.repeat(sums, np.diff(self.starts))).astype(dtype)
        rng = np.random.default_rng(7)
        normal = lambda *shape: rng.normal(size=shape).astype(dtype)
        self.weights = {
            "ids": normal(self.size, width) * dtype(0.5),
            "qkv": normal(width, 3 * width) / dtype(np.sqrt(width)),
            "out": normal(width, width) / dtype(np.sqrt(width)),
            "distance": np.zeros(2 * stride, dtype),
            "up": normal(width, hidden) / dtype(np.sqrt(width)),
            "bias": np.zeros(hidden, dtype),
            "down": normal(hidden, width) / dtype(np.sqrt(hidden)),
            "classes": np.zeros((width, len(sums)), dtype),
            "places": np.zeros((self.size, width), dtype),
        }
        # How far each key of a window lies before each query, below 0 for keys that come later.
        self.apart = stride + np.arange(stride)[:, None] - np.arange(2 * stride)[None, :]

    def strides(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs and targets (PAD: none) of all texts in strides, and the text of each stride; ids of text i are ids[bounds[i] : bounds[i + 1]]."""
        sizes = np.diff(bounds) + 1
        many = -(-sizes // self.stride)
        first = (np.cumsum(many) - many) * self.stride
        inputs = np.full(many.sum() * self.stride, self.end, np.int64)
        targets = np.full(len(inputs), PAD, np.int64)
        at = np.repeat(first - bounds[:-1], sizes - 1) + np.arange(bounds[0], bounds[-1])
        targets[at] = ids[bounds[0] : bounds[-1]]
        inputs[at + 1] = ids[bounds[0] : bounds[-1]]
        targets[first + sizes - 1] = self.end
        return inputs.reshape(-1, self.stride), targets.reshape(-1, self.stride), np.repeat(np.arange(len(sizes)), many)

    def hidden(self, inputs: np.ndarray, follows: np.ndarray, step: int = 1) -> tuple[np.ndarray, tuple]:
        """The last layer of strides 1, 1 + step, ..., one row per token; each has the stride before it as context.

        ``follows``: whether the stride before belongs to the same text.
        """
        w, s = self.weights, self.stride
        width = w["out"].shape[0]
        x = w["ids"].take(inputs.reshape(-1), axis=0).reshape(*inputs.shape, width)
        qkv = x.reshape(-1, width) @ w["qkv"]
        scale = x.dtype.type(1 / np.sqrt(width))
        n, size = len(range(1, len(inputs), step)), qkv.itemsize
        # Windows of two strides overlap in memory; nothing is copied.
        windows = np.lib.stride_tricks.as_strided(qkv, (n, 2 * s, 3 * width), (step * s * 3 * width * size, 3 * width * size, size), writeable=False)
        q = windows[:, s:, :width] * scale
        k, v = windows[:, :, width : 2 * width], windows[:, :, 2 * width :]
        bias = np.where(self.apart >= 0, w["distance"][np.maximum(self.apart, 0)], x.dtype.type(-1e30))
        a, sums, mixed = np.empty((n, s, 2 * s), x.dtype), np.empty((n, s, 1), x.dtype), np.empty((n, s, width), x.dtype)
        begins = ~follows[1::step]
        for i in range(0, n, PASS):
            part = slice(i, i + PASS)
            logits = np.matmul(q[part], k[part].transpose(0, 2, 1))
            logits += bias
            logits[begins[part], :, :s] = -1e30
            weights, of_row, _ = exponents(logits.reshape(-1, 2 * s))
            a[part], sums[part] = weights.reshape(logits.shape), of_row.reshape(-1, s, 1)
            np.matmul(a[part], v[part], out=mixed[part])
            mixed[part] /= sums[part]
        mixed = mixed.reshape(-1, width)
        h = mixed @ w["out"]
        h += x[1::step].reshape(-1, width)
        u = h @ w["up"]
        u += w["bias"]
        np.maximum(u, 0, out=u)
        z = u @ w["down"]
        z += h
        return z, (x, q, k, v, a, sums, mixed, h, u, scale)

    def log_probs(self, inputs: np.ndarray, targets: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each target, 0 for PAD."""
        w, out = self.weights, np.zeros(targets.shape, np.float64)
        follows = np.zeros(len(text), bool)
        follows[1:] = text[1:] == text[:-1]
        for i in range(0, len(inputs), CHUNK):
            j = min(i + CHUNK, len(inputs))
            goal = targets[i:j].reshape(-1)
            known = np.flatnonzero(goal != PAD)
            goal = goal[known]
            rows = []
            for p in range(i, j, PASS):
                # One stride more in front: its keys are the context of the first.
                part = np.maximum(np.arange(p - 1, min(p + PASS, j)), 0)
                rows.append(self.hidden(inputs[part], follows[part])[0])
            z = np.concatenate(rows).take(known, axis=0)
            found = np.empty(len(goal), np.float64)
            for p in range(0, len(goal), PASS * self.stride):
                part = slice(p, p + PASS * self.stride)
                logits = z[part] @ w["classes"]
                logits += self.class_bias
                found[part] = picked(logits, self.kind[goal[part]])[0]
            # From here on in order of classes.
            order = sorted_places(self.kind[goal], len(self.starts))
            goal, z, found, known = goal[order], z.take(order, axis=0), found[order], known[order]
            place = self.place[goal]
            for c, at in grouped(self.kind[goal], np.diff(self.starts)):
                begin, end = self.starts[c], self.starts[c + 1]
                if end - begin > 1:
                    logits = z[at] @ w["places"][begin:end].T
                    logits += self.id_bias[begin:end]
                    found[at] += picked(logits, place[at] - begin)[0]
            flat = out[i:j].reshape(-1)
            flat[known] = found
        return out

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, follows: np.ndarray, step: int = 1) -> tuple[float, dict]:
        """Sum of the log-probabilities of the targets of strides 1, 1 + step, ..., and its gradients; of ids and places, the rows met and theirs."""
        w, s = self.weights, self.stride
        width = w["out"].shape[0]
        z, (x, q, k, v, a, sums, mixed, h, u, scale) = self.hidden(inputs, follows, step)
        goal = targets[1::step].reshape(-1)
        known = np.flatnonzero(goal != PAD)
        goal, y, g = goal[known], z.take(known, axis=0), {}
        kinds, total = self.kind[goal], 0.0
        d = y @ w["classes"]
        for i in range(0, len(goal), PASS * s):
            part = slice(i, i + PASS * s)
            d[part] += self.class_bias
            value, d[part] = picked(d[part], kinds[part], True)
            total += float(value.sum())
        g["classes"], dy = y.T @ d, d @ w["classes"].T
        # From here on in order of classes.
        order = sorted_places(kinds, len(self.starts))
        known, place, y, dy = known[order], self.place[goal[order]], y.take(order, axis=0), dy.take(order, axis=0)
        rows, slopes = [], []
        for c, at in grouped(kinds[order], np.diff(self.starts)):
            begin, end = self.starts[c], self.starts[c + 1]
            if end - begin > 1:
                logits = y[at] @ w["places"][begin:end].T
                logits += self.id_bias[begin:end]
                value, d = picked(logits, place[at] - begin, True)
                total += float(value.sum())
                if rows and rows[-1][0] == begin:
                    slopes[-1] += d.T @ y[at]
                else:
                    rows.append(np.arange(begin, end))
                    slopes.append(d.T @ y[at])
                dy[at] += d @ w["places"][begin:end]
        g["places"] = (np.concatenate(rows), np.concatenate(slopes)) if rows else (np.zeros(0, np.int64), w["places"][:0])
        dz = np.zeros_like(z)
        dz[known] = dy
        g["down"] = u.T @ dz
        du = dz @ w["down"].T
        du *= u > 0
        g["up"], g["bias"] = h.T @ du, du.sum(axis=0)
        dh = du @ w["up"].T
        dh += dz
        g["out"] = mixed.T @ dh
        dmixed = (dh @ w["out"].T).reshape(-1, s, width)
        apart, d = np.zeros((1, s, 2 * s), z.dtype), np.zeros((*inputs.shape, 3 * width), z.dtype)
        # Back through attention by passes, whose arrays stay in the processor's cache.
        for i in range(0, len(q), PASS):
            part = slice(i, i + PASS)
            a[part] /= sums[part]
            da = np.matmul(dmixed[part], v[part].transpose(0, 2, 1))
            dkv = np.empty((len(da), 2 * s, 2 * width), z.dtype)
            dkv[:, :, width:] = np.matmul(a[part].transpose(0, 2, 1), dmixed[part])
            da -= (da * a[part]).sum(axis=2, keepdims=True)
            da *= a[part]
            apart = np.concatenate([apart, da]).sum(axis=0, keepdims=True)
            dkv[:, :, :width] = np.matmul(da.transpose(0, 2, 1), q[part])
            before, own = (d[m + i * step :: step][: len(da)] for m in (0, 1))
            np.multiply(np.matmul(da, k[part]), scale, out=own[:, :, :width])
            own[:, :, width:] += dkv[:, s:]
            # No attention reaches back over the beginning of a text, so those gradients are 0.
            before[:, :, width:] += dkv[:, :s]
        near = self.apart >= 0
        g["distance"] = np.bincount(self.apart[near], apart[0][near], 2 * s).astype(z.dtype)
        d = d.reshape(-1, 3 * width)
        g["qkv"] = x.reshape(-1, width).T @ d
        dx = (d @ w["qkv"].T).reshape(x.shape)
        dx[1::step] += dh.reshape(-1, s, width)
        flat = inputs.reshape(-1)
        at = sorted_places(flat, self.size)
        first = np.flatnonzero(np.diff(flat[at], prepend=-1))
        g["ids"] = (flat[at[first]], np.add.reduceat(dx.reshape(-1, width).take(at, axis=0), first))
        return total, g


def sorted_places(numbers: np.ndarray, size: int) -> np.ndarray:
    """The places of numbers below ``size`` in their order, equal ones as they stand. Narrow numbers take a radix sort."""
    return np.argsort(numbers.astype(np.uint16) if size <= 1 << 16 else numbers, kind="stable")


def exponents(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp of each row, its sum, and what was taken off first: the largest of the row, but only if exponents are too large or small for the type."""
    with np.errstate(over="ignore"):
        out = np.exp(logits)
        sums = out @ np.ones(logits.shape[1], logits.dtype)
    if not len(sums) or sums.min() > 1e-30 and sums.max() < np.inf:
        return out, sums, 0.0
    top = logits.max(axis=1)
    out = np.exp(logits - top[:, None])
    return out, out.sum(axis=1), top


def picked(logits: np.ndarray, choice: np.ndarray, slopes: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probability of one choice a row, and its slope by each logit."""
    rows = np.arange(len(choice))
    parts, sums, off = exponents(logits)
    value = logits[rows, choice] - np.log(sums) - off
    if not slopes:
        return value, None
    parts /= -sums[:, None]
    parts[rows, choice] += 1
    return value, parts


def grouped(kinds: np.ndarray, sizes: np.ndarray):
    """Each of the sorted ``kinds`` with the slice where it stands, at most `LOGITS` numbers at a time where a kind takes ``sizes`` numbers a place."""
    cuts = np.flatnonzero(np.diff(kinds, prepend=-1)).tolist()
    for i, j in zip(cuts, [*cuts[1:], len(kinds)]):
        c = kinds[i]
        step = max(1, LOGITS // int(sizes[c]))
        for k in range(i, j, step):
            yield c, slice(k, min(k + step, j))


class Trainer:
    """Adagrad steps on a model."""

    def __init__(self, model: Model, rate: float = 0.1):
        self.model, self.rate = model, rate
        self.squares = {k: np.full_like(v, 1e-3) for k, v in model.weights.items()}

    def step(self, inputs: np.ndarray, targets: np.ndarray, follows: np.ndarray, step: int = 1) -> float:
        total, gradients = self.model.gradients(inputs, targets, follows, step)
        for name, g in gradients.items():
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            squares = self.squares[name][rows]
            squares += g * g
            self.squares[name][rows] = squares
            self.model.weights[name][rows] += self.rate * g / np.sqrt(squares)
        return total
