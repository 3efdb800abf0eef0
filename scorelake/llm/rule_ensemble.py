"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Statistics of every text are numbers of a fixed list. Small boosted trees on labelled
rows give paths; each path is a rule, a conjunction of thresholds. A lasso
logistic regression over rules and clipped statistics leaves few weights, and what
is left is compiled into one Spark column expression that scores all rows.
Labels come only from rows that are not held out, from at most ``sample`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, buffers, passes, ship, stored, text_of, words_of

#: Labelled rows that the trees and weights are fitted on at most, chosen by the digest of doc_id.
SAMPLE = 20_000
TREES, DEPTH, LEAF, RATE = 40, 3, 20, 0.2
LASSO, STEPS = 0.002, 400
THRESHOLD = 0.3

STATISTICS = [
    "log_chars", "log_words", "word_length", "long_words", "short_words", "upper_share", "digit_share", "space_share",
    "mark_share", "symbol_share", "exclaim_share", "other_share", "words_with_symbol", "words_all_upper", "words_with_digit",
    "distinct_words", "top_word", "distinct_pairs", "repeated_next", "log_lines", "line_length", "repeated_lines", "short_lines",
    "end_mark", "sentence_length", "pipe_share",
]


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


CLASSES = {
    "upper": _class(bytes(range(65, 91))),
    "digit": _class(bytes(range(48, 58))),
    "space": _class(b" \t\n\r\x0b\x0c"),
    "mark": _class(b".,;:?!'\"()-"),
    "symbol": _class(b"#*$%&<>@^~=+_{}[]\\/|"),
    "exclaim": _class(b"!"),
    "other": _class(bytes(range(128, 256))),
    "pipe": _class(b"|"),
    "stop": _class(b".?!"),
}


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of `STATISTICS` for each text; shares of nothing are 0."""
    n = len(offsets) - 1
    out = dict.fromkeys(STATISTICS)
    starts, ends, bounds = words_of(data, offsets)
    size, words = np.diff(offsets).astype(float), np.diff(bounds).astype(float)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    sums = lambda flags, at: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = lead[ends] - lead[starts]
    chars = np.diff(lead[offsets]).astype(float)
    counts = {k: np.concatenate([[0], np.cumsum(t[data])]) for k, t in CLASSES.items()}
    total = {k: np.diff(c[offsets]) for k, c in counts.items()}
    in_word = lambda k: counts[k][ends] - counts[k][starts]
    doc = np.repeat(np.arange(n), np.diff(bounds))
    ids = Prefix(data).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    out["log_chars"], out["log_words"] = np.log1p(chars), np.log1p(words)
    out["word_length"] = share(sums(length, bounds), words)
    out["long_words"] = share(sums(length > 12, bounds), words)
    out["short_words"] = share(sums(length <= 3, bounds), words)
    for k in ("upper", "digit", "space", "mark", "symbol", "exclaim", "pipe", "other"):
        out[f"{k}_share"] = share(total[k], size)
    out["words_with_symbol"] = share(sums(in_word("symbol") > 0, bounds), words)
    out["words_all_upper"] = share(sums((in_word("upper") >= 2) & (in_word("upper") >= 0.6 * length), bounds), words)
    out["words_with_digit"] = share(sums(in_word("digit") > 0, bounds), words)

    def kinds(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different keys of each text, and how often the most frequent stands."""
        if not len(keys):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(new)
        runs = np.diff(np.append(at, len(k)))
        most = np.zeros(n)
        np.maximum.at(most, o[at], runs)
        return np.bincount(o[at], minlength=n).astype(float), most

    different, most = kinds(ids, doc)
    out["distinct_words"], out["top_word"] = share(different, words), share(most, words)
    pair = (doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, bool)
    pairs = (ids[1:] * np.uint64(0x9E3779B97F4A7C15) + ids[:-1])[pair] if len(ids) else ids
    some = np.maximum(words - 1, 0)
    out["distinct_pairs"] = share(kinds(pairs, doc[1:][pair])[0] if len(doc) else np.zeros(n), some)
    same = pair & (ids[1:] == ids[:-1]) if len(ids) else pair
    out["repeated_next"] = share(np.bincount(doc[1:][same], minlength=n).astype(float) if len(doc) else np.zeros(n), some)
    feeds = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate([offsets[:-1][size > 0], feeds + 1]))
    first = first[first < len(data)]
    owner = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(feeds, len(data))[np.searchsorted(feeds, first)], offsets[1:][owner])
    solid = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, owner = first[solid], last[solid], owner[solid]
    lines = np.bincount(owner, minlength=n).astype(float)
    lines_kinds = kinds(Prefix(data).hash(first, last) if len(first) else np.zeros(0, np.uint64), owner)[0]
    out["log_lines"], out["line_length"] = np.log1p(lines), np.log1p(share(chars, lines))
    out["repeated_lines"] = share(lines - lines_kinds, lines)
    out["short_lines"] = share(np.bincount(owner[last - first < 30], minlength=n).astype(float), lines)
    final = CLASSES["stop"][data[last - 1]] if len(last) else np.zeros(0, bool)
    out["end_mark"] = share(np.bincount(owner[final], minlength=n).astype(float), lines)
    out["sentence_length"] = np.log1p(words / (total["stop"] + 1))
    return np.stack([out[s] for s in STATISTICS], axis=1)


def with_statistics(text: Column) -> Column:
    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        parts = [statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in passes(offsets)]
        rows = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=STATISTICS)

    return run(text)


# Rules


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, above, t in self.terms:
            out &= (x[:, j] > t) == above
        return out

    def column(self, row: Column) -> Column:
        out = F.lit(True)
        for j, above, t in self.terms:
            out = out & ((row[STATISTICS[j]] > t) if above else (row[STATISTICS[j]] <= t))
        return out


def grow(x: np.ndarray, gradient: np.ndarray, cuts: list[np.ndarray], depth: int = DEPTH, leaf: int = LEAF) -> list[tuple[Rule, np.ndarray]]:
    """All paths of one regression tree on ``gradient``, with the rows of each; ends have the longest paths."""
    codes = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    found: list[tuple[Rule, np.ndarray]] = []

    def split(rows: np.ndarray, terms: tuple) -> None:
        if terms:
            found.append((Rule(terms), rows))
        if len(terms) == depth or len(rows) < 2 * leaf:
            return
        g = gradient[rows]
        best = (1e-9, None, None)
        for j, c in enumerate(cuts):
            if not len(c):
                continue
            k = codes[rows, j]
            n = np.cumsum(np.bincount(k, minlength=len(c) + 1))[:-1]
            s = np.cumsum(np.bincount(k, g, minlength=len(c) + 1))[:-1]
            m, r = len(rows) - n, g.sum() - s
            good = (n >= leaf) & (m >= leaf)
            gain = np.where(good, s**2 / np.maximum(n, 1) + r**2 / np.maximum(m, 1) - g.sum() ** 2 / len(rows), 0)
            i = int(gain.argmax())
            if gain[i] > best[0] * (1 + 1e-9):
                best = (gain[i], j, float(c[i]))
        if best[1] is None:
            return
        above = x[rows, best[1]] > best[2]
        for side in (False, True):
            split(rows[above == side], (*terms, (best[1], side, best[2])))

    split(np.arange(len(x)), ())
    return found


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> list[Rule]:
    """Rules of boosted trees, each kind of path once."""
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 33), method="lower")) for c in x.T]
    cuts = [c[c < col.max()] for c, col in zip(cuts, x.T)]
    score = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    rules: dict[Rule, None] = {}
    rng = np.random.default_rng(0)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        part = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        paths = grow(x[part], (y - p)[part], cuts)
        ends = [r for r, _ in paths if not any(o.terms[: len(r.terms)] == r.terms and len(o.terms) > len(r.terms) for o, _ in paths)]
        for r, _ in paths:
            rules.setdefault(r)
        for r in ends:
            here = r.holds(x)
            score[here] += RATE * np.clip((y - p)[here].sum() / max((p * (1 - p))[here].sum(), 1e-6), -4, 4)
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, strength: float = LASSO, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradients; the intercept is free."""
    n, k = x.shape
    full = np.hstack([np.ones((n, 1)), x]).astype(np.float64)
    vector = np.ones(k + 1)
    for _ in range(30):  # the largest eigenvalue bounds the step
        vector = full.T @ (full @ vector)
        vector /= np.linalg.norm(vector)
    step = 1 / (0.25 * float(vector @ (full.T @ (full @ vector))) / n * 1.05 + 1e-9)
    w, v, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ v, -30, 30)))
        new = v - step * (full.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * strength, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return float(w[0]), w[1:]


@dataclass
class Ensemble:
    """Weighted rules, and weighted statistics clipped to ``low`` ... ``high``."""

    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[int, float, float, float]]

    def column(self, row: Column) -> Column:
        """The likelihood of label 1 as one expression over a struct of statistics."""
        total = F.lit(self.intercept)
        for rule, w in self.rules:
            total = total + F.when(rule.column(row), F.lit(w)).otherwise(F.lit(0.0))
        for j, w, low, high in self.linear:
            total = total + F.lit(w) * F.greatest(F.lit(low), F.least(F.lit(high), row[STATISTICS[j]]))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, w in self.rules:
            total += w * rule.holds(x)
        for j, w, low, high in self.linear:
            total += w * np.clip(x[:, j], low, high)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Without rows of both labels the score is their share, or one half of none."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Ensemble(float(np.log(p / (1 - p))), [], [])
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    rules = tree_rules(x, y)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    mean, spread = clipped.mean(axis=0), clipped.std(axis=0)
    spread[spread == 0] = np.inf
    # A clipped statistic weighs as much as a rule of middle support.
    linear = 0.4 * (clipped - mean) / spread
    held = np.stack([r.holds(x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(x), 0))
    b, w = lasso(np.hstack([held, linear]), y)
    kept = [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-6]
    own = w[len(rules) :] * 0.4 / spread
    b -= float((own * mean).sum())
    return Ensemble(b, kept, [(j, float(c), float(low[j]), float(high[j])) for j, c in enumerate(own) if abs(c) > 1e-9])


def held_out() -> Column:
    """Whether crc32 of doc_id as text is a multiple of 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(statistics_: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """Fit on at most ``sample`` labelled rows that are not held out.

    Several labels of a document count by their majority, ties as 1; null labels and ids
    don't count. Of repeated rows of an id, each counts.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("y"))
    rows = statistics_.where(~held_out()).join(marks, "doc_id")
    # A share by digest first, so that all tasks together send the driver no more than the sample.
    share = min(1.0, 0.95 * sample / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) < F.lit(int(share * 1_000_000_007)))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    got = some.select((F.col("y") >= 0.5).cast("double").alias("y"), *[F.col(f"s.{s}") for s in STATISTICS]).toPandas()
    return fit(got[STATISTICS].to_numpy(float), got["y"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    A null text is empty and is scored by its statistics, which are all 0. Rows that
    repeat have equal scores. An empty table gives no rows; without labels the score is 0.5.
    """
    ship(docs.sparkSession)
    found = stored(docs.select("doc_id", with_statistics(text_of(docs)).alias("s")), "statistics")
    model = train(found, labels.select("doc_id", label), label, sample)
    out = found.select("doc_id", held_out().alias("held_out"), model.column(F.col("s")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
