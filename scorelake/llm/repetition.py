"""Quality rules from the repeats inside a text.

The words of a text are ranked by a suffix array (prefix doubling: suffixes are
ordered by their first 1, 2, 4 ... words, and those that stand alone are done). The
longest common prefixes of neighbours give the intervals of repeated substrings; a
position's longest repeat is the larger prefix it shares with a neighbour. The spans
of the maximal repeats are united: the share of words that they cover and the longest
repeat decide. Many texts are ranked at once, and no prefix goes over the end of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, buffers, passes, ship, text_of, words_of

RESULT = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_covered:long,longest_repeat:long>"
#: Words of a window of the base rule, and of the shortest repeat that counts in the method's.
WINDOW, SHORTEST = 3, 8
#: The method's limits: words covered by repeats, of 100, and the longest repeat in words and of 100.
COVERED, LONGEST, LONGEST_SHARE = 50, 100, 40


def suffix_ranks(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of many texts in a row, and the common prefix of each suffix with the next in words.

    ``words`` are numbers, ``ends`` for each word the end of its text. Prefixes stop
    at ends; equal suffixes of several texts are neighbours in any order.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    new = np.ones(n, bool)
    new[1:] = sorted_words[1:] != sorted_words[:-1]
    # The rank of a suffix is the place of the first of its equals, from 1; 0 stands behind the end.
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    same = [(1, rank[:n].copy())]
    depth = 1
    tied = ~new
    tied[:-1] |= ~new[1:]
    places = np.flatnonzero(tied)
    while len(places):
        some = order[places]
        after = some + depth
        second = np.where(after < ends[some], rank[np.minimum(after, n)], 0)
        first = rank[some]
        by = np.lexsort((second, first))
        some, first, second = some[by], first[by], second[by]
        order[places] = some
        new = np.ones(len(some), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        start = np.maximum.accumulate(np.where(new, places, 0))
        rank[some] = start + 1
        depth *= 2
        same.append((depth, rank[:n].copy()))
        # Suffixes that end together with their equals can't be told apart further.
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_ = some + depth < ends[some]
        group = np.cumsum(new) - 1
        live = np.bincount(group, open_)[group] > 0
        places = places[tied & live]
    prefix = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for depth, ranks in reversed(same):
        inside = (a < n) & (b < n)
        x, y = np.minimum(a, n - 1), np.minimum(b, n - 1)
        end_a, end_b = ends[order[:-1]], ends[order[1:]]
        equal = inside & (a + depth <= end_a) & (b + depth <= end_b) & (ranks[x] == ranks[y])
        prefix[:-1][equal] += depth
        a[equal] += depth
        b[equal] += depth
    return order, prefix


def longest_repeats(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word, how many words from it on stand elsewhere in its text too."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    # The text's number is part of a word: neighbours of other texts share nothing.
    _, ids = np.unique(words, return_inverse=True)
    _, ids = np.unique(doc * (int(ids.max()) + 1) + ids, return_inverse=True)
    order, prefix = suffix_ranks(ids.astype(np.int64), bounds[1:][doc])
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(prefix, np.concatenate([[0], prefix[:-1]]))
    return out


def covered(repeats: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Whether a word lies in a repeat of ``least`` words or more."""
    n = len(repeats)
    reach = np.where(repeats >= least, np.arange(n) + repeats, 0)
    return np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, bool)


SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"[#*$%&|<>]", np.uint8)[1:-1])


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The numbers of `RESULT`, a row for each text."""
    out = np.zeros((len(offsets) - 1, 7), np.int64)
    if not len(data):
        return out
    starts, ends, bounds = words_of(data, offsets)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    by_word = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])
    slices = Prefix(data)
    out[:, 0] = np.diff(bounds)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out[:, 1] = np.diff(np.concatenate([[0], np.cumsum(lead[ends] - lead[starts])])[bounds])
    out[:, 2] = total(SYMBOLS[data])
    # Lines: between line feeds, or the ends of the text.
    feeds = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], feeds + 1]))
    first = first[first < len(data)]
    doc = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(feeds, len(data))[np.searchsorted(feeds, first)], offsets[1:][doc])
    solid = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, doc = first[solid], last[solid], doc[solid]
    lines, seen = np.unique(np.stack([doc.astype(np.uint64), slices.hash(first, last)]), axis=1, return_counts=True)
    out[:, 3] = np.bincount(lines[0].astype(np.int64), seen - 1, len(out)).astype(np.int64)
    repeats = longest_repeats(slices.hash(starts, ends), bounds)
    # A window found twice starts at every word from which three or more repeat.
    out[:, 4] = by_word(covered(np.minimum(repeats, WINDOW), bounds, WINDOW))
    out[:, 5] = by_word(covered(repeats, bounds, SHORTEST))
    if len(repeats):
        some = np.flatnonzero(np.diff(bounds))
        out[some, 6] = np.maximum.reduceat(repeats, bounds[:-1][some])
    return out


def measures(text: Column) -> Column:
    """`measure` of a column of texts."""

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        parts = [measure(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in passes(offsets)]
        rows = np.concatenate(parts) if parts else np.zeros((0, 7), np.int64)
        names = [f.split(":")[0] for f in RESULT[7:-1].split(",")]
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)

    return run(text)


def with_quality(docs: DataFrame, column: str = "quality", covered_limit: int = COVERED, longest: int = LONGEST, share: int = LONGEST_SHARE) -> DataFrame:
    """``docs`` with a struct of the measures, base_failed and kept; other columns stay.

    A null text has no words. A text with no words fails the base rule. Rows that
    repeat are judged each by itself, and an empty table gives none.
    """
    ship(docs.sparkSession)
    taken = {c.lower() for c in docs.columns}
    inner = column if column.lower() not in taken else "_" * max(map(len, taken)) + column
    found = docs.withColumn(inner, measures(text_of(docs)))
    q = lambda name: found[inner][name]
    failed = (q("n_words") < 50) | (100 * q("n_repeat_words") > 50 * q("n_words"))
    repeats = (100 * q("n_covered") > covered_limit * q("n_words")) | (
        (q("longest_repeat") > longest) & (100 * q("longest_repeat") > share * q("n_words"))
    )
    fields = [q(f.split(":")[0]).alias(f.split(":")[0]) for f in RESULT[7:-1].split(",")]
    verdict = F.struct(*fields, failed.alias("base_failed"), (~failed & ~repeats).alias("kept"))
    return found.withColumn(inner, verdict).withColumnRenamed(inner, column) if inner == column else found.withColumn(inner, verdict)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row."""
    return with_quality(docs.select("doc_id", "text")).select("doc_id", "quality.*")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows that pass, with the columns of ``docs``."""
    names = docs.columns
    judged = with_quality(docs)
    verdict = next(c for c in judged.columns if c not in names)
    return judged.where(judged[verdict]["kept"]).select(*[judged[f"`{c}`"] for c in names])
