"""Removal of 200-byte strings that occur more than once, by suffix sorting.

*Anchors.* Every window of 200 bytes takes the least hash of the 32-byte strings in it
as its anchor, so equal windows have equal anchors; consecutive windows of one anchor
form a stretch. Only stretches whose anchor string occurs again can hold repeats, and
only these go on.

*Equal stretches* repeat as a whole. Of the others in an anchor's group one row each
remains, with its bytes. The suffixes that start at the anchor, and the reversed prefixes
that end there, are sorted deep-shallow: multikey quicksort on eight bytes a level down to
a shallow depth, then a blind trie for each group with a longer common prefix. A
window repeats if another stretch of the group shares enough bytes on both sides, which the
classes of both orders at the two depths tell without comparing pairs.

*Hot groups* with more different stretches than a task should sort are cut into cells of a few
windows, whose shared bytes are their anchor. Cells that are equal fall together, and what
differs is sorted as above; groups that are still hot are cut into single windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, buffers, passes, ship, stored, text_of

WINDOW, CORE = 200, 32
#: Depth in bytes to which multikey quicksort goes.
SHALLOW = 64
#: Different stretches of a group that one task sorts; the rest of the rows are sorted in lots of so many.
SORTED_TOGETHER, LOT = 2000, 20_000
#: Windows of a cell of a hot group, and of a cell of a group that is still hot.
CELLS = (8, 1)
#: Window starts of a very long text that are handled at once.
SEGMENT = 1 << 20
#: Enough for a place in a pass or a segment.
PLACE_BITS = 23
OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


# Anchors


def stretches(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, core: int = CORE):
    """(text, first window, windows, anchor behind the first window, anchor hash, stretch hash) of each stretch."""
    n, width = len(data), window - core + 1
    if n < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    slices = Prefix(data)
    at = np.arange(n - core + 1)
    hashes = slices.hash(at, at + core)
    # Hash above, place below: the least is the first of the least hashes.
    bits = np.uint64(PLACE_BITS)
    keys = (hashes >> bits << bits) | at.astype(np.uint64)
    rows = -(-len(keys) // width) + 1
    padded = np.full(rows * width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(offsets, offsets[1:]) if b - a >= window] or [np.zeros(0, np.int64)])
    if not len(starts):
        return stretches(data[:0], offsets * 0, window, core)
    least = np.minimum(behind[starts], ahead[starts + width - 1])
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], anchor[first]
    text = np.searchsorted(offsets, begin, "right") - 1
    whole = slices.hash(begin, begin + many + window - 1)
    return text, begin - offsets[text], many, anchor - begin, hashes[anchor], whole


def segments(data: np.ndarray, offsets: np.ndarray, window: int):
    """(first text, bytes skipped of it, data, offsets) in passes; very long texts in overlapping segments."""
    for i, j in passes(offsets):
        if offsets[j] - offsets[i] <= 2 * SEGMENT or j - i > 1:
            yield i, 0, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        else:
            for a in range(offsets[i], offsets[j] - window + 1, SEGMENT):
                b = min(a + SEGMENT + window - 1, offsets[j])
                yield i, a - offsets[i], data[a:b], np.array([0, b - a])


# Deep-shallow sorting


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings that agree in the first ``at`` bytes."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    x = int.from_bytes(a[at:n], "big") ^ int.from_bytes(b[at:n], "big")
    return at + (n - at) - (x.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], at: int) -> tuple[list[int], list[int]]:
    """Order of different strings that share ``at`` bytes, and the common prefix of each with the one before (first: ``at``).

    Inner nodes hold only a depth and branches by the byte there (-1: the end). A new
    string goes down without comparing, is compared with the leaf found, and gets
    its branch at the depth of the first difference.
    """
    def byte(s: bytes, i: int) -> int:
        return s[i] if i < len(s) else -1

    root: list | int = 0
    for k in range(1, len(strings)):
        s, node, path = strings[k], root, []
        while not isinstance(node, int):
            path.append(node)
            node = node[1].get(byte(s, node[0]))
            if node is None:
                node = next(iter(path[-1][1].values()))
        other = strings[node]
        depth = common(s, other, at)
        above, below = None, root
        while not isinstance(below, int) and below[0] < depth:
            above, below = below, below[1][byte(other, below[0])]
        if not isinstance(below, int) and below[0] == depth:
            below[1][byte(s, depth)] = k
            continue
        node = [depth, {byte(other, depth): below, byte(s, depth): k}]
        if above is None:
            root = node
        else:
            above[1][byte(other, above[0])] = node
    order, shared, stack = [], [], [(root, at)]
    while stack:
        node, depth = stack.pop()
        if isinstance(node, int):
            order.append(node)
            shared.append(depth)
            continue
        branches = [node[1][c] for c in sorted(node[1])]
        # The first branch continues what came before this node; the others share its depth.
        stack += [(b, node[0]) for b in reversed(branches[1:])] + [(branches[0], depth)]
    return order, shared


def deep_shallow(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings inside their groups (numbers in ascending order), and the common prefix with the one before.

    The prefix of a group's first string is 0; equal strings are neighbours that share all.
    """
    n = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    depth_bytes = SHALLOW
    flat = np.zeros((n, depth_bytes), np.uint8)
    for i, s in enumerate(strings):
        part = s[:depth_bytes]
        flat[i, : len(part)] = np.frombuffer(part, np.uint8)
    keys = flat.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    klass = group[order].astype(np.int64)
    shared = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)  # places whose neighbour before is not yet told apart
    open_[0:1] = False
    open_[1:] = klass[1:] == klass[:-1]
    for level in range(depth_bytes // 8):
        if not open_.any():
            break
        ends = np.append(~open_, True)
        live = np.flatnonzero(open_ | ~ends[1:])
        # Classes of one string are done.
        number = np.cumsum(~open_)[live]
        key = keys[order[live], level]
        # A string that ends inside this level stands before the ones that go on with zero bytes.
        left = np.clip(sizes[order[live]] - 8 * level, 0, 8)
        by = np.lexsort((left, key, number))
        order[live], key, left = order[live][by], key[by], left[by]
        same_class = np.zeros(len(live), bool)
        same_class[1:] = number[1:] == number[:-1]
        diff = np.zeros(len(live), np.uint64)
        diff[1:] = key[1:] ^ key[:-1]
        equal = np.full(len(live), 8)
        some = np.flatnonzero(diff)
        for i in range(7, -1, -1):
            equal[some[(diff[some] >> np.uint64(56 - 8 * i)) != 0]] = i
        ends_at = np.full(len(live), 8)
        ends_at[1:] = np.minimum(left[1:], left[:-1])
        equal = np.minimum(equal, ends_at)
        shared[live[same_class]] += equal[same_class]
        open_[live] = same_class & (equal == 8)
    # What is left agrees in the shallow depth: a blind trie for each class.
    edges = np.append(np.flatnonzero(~open_), n)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a < 2:
            continue
        distinct: dict[bytes, list[int]] = {}
        for i in order[a:b].tolist():
            distinct.setdefault(strings[i], []).append(i)
        texts = list(distinct)
        at, (ranks, depths) = a, blind_trie(texts, min(depth_bytes, min(map(len, texts))))
        for k, depth in zip(ranks, depths):
            for twin, i in enumerate(distinct[texts[k]]):
                order[at] = i
                if at > a:
                    shared[at] = len(texts[k]) if twin else depth
                at += 1
    return order, shared


def repeated_windows(group: np.ndarray, first: np.ndarray, many: np.ndarray, seen: np.ndarray, texts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each stretch, whether each of its windows stands in another stretch of its group, or it was seen twice.

    ``first`` is the anchor's place in the stretch.
    """
    n = len(texts)
    right, right_shared = deep_shallow([t[a:] for t, a in zip(texts, first.tolist())], group)
    left, left_shared = deep_shallow([t[:a][::-1] for t, a in zip(texts, first.tolist())], group)
    fresh_right = np.concatenate([[True], group[right][1:] != group[right][:-1]])
    fresh_left = np.concatenate([[True], group[left][1:] != group[left][:-1]])
    out = [np.full(m, s > 1) for m, s in zip(many.tolist(), seen.tolist())]
    for before in range(int(first.max()) + 1 if n else 0):
        place = first - before  # the window with so many bytes before the anchor
        have = np.flatnonzero((place >= 0) & (place < many))
        if len(have) < 2:
            continue
        by_right, by_left = np.empty(n, np.int64), np.empty(n, np.int64)
        by_right[right] = np.cumsum(fresh_right | (right_shared < window - before))
        by_left[left] = np.cumsum(fresh_left | (left_shared < before))
        both = by_right[have] * (n + 1) + by_left[have]
        _, where, count = np.unique(both, return_inverse=True, return_counts=True)
        for i in have[(count[where] > 1) & (seen[have] == 1)].tolist():
            out[i][place[i]] = True
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


# The job


def anchored(docs: DataFrame, window: int = WINDOW, core: int = CORE) -> DataFrame:
    """A row for each stretch: anchor, stretch, doc_id, place (mark of the text above, first window below)."""
    names = ["anchor", "stretch", "doc_id", "place"]

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            ids, marks = batch.column(0), batch.column(1).to_numpy()
            for i, skip, part, bounds in segments(data, offsets, window):
                text, begin, many, first, anchor, whole = stretches(part, bounds, window, core)
                if len(text):
                    # 48 bits of the hash, the number of windows and the anchor's place.
                    stretch = (whole >> np.uint64(16) << np.uint64(16)) | (many.astype(np.uint64) << np.uint64(8)) | first.astype(np.uint64)
                    place = (marks[text + i].astype(np.int64) << 32) | (begin + skip)
                    columns = [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), ids.take(pa.array(text + i)), pa.array(place)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "mark", "text").mapInArrow(run, "anchor long, stretch long, doc_id long, place long")


def bytes_of(found: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """``found`` (anchor, stretch, doc_id, place, seen, kinds) with the bytes of each stretch."""
    mark = F.shiftright("place", 32).cast("int")
    wanted = found.groupBy("doc_id", mark.alias("mark")).agg(F.collect_list(F.struct("anchor", "stretch", "place", "seen", "kinds")).alias("wanted"))
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["mark"] == wanted["mark"])
    held = docs.join(wanted, same).select(docs["doc_id"], "text", "wanted")
    names = ["anchor", "stretch", "doc_id", "place", "seen", "kinds", "bytes"]

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            raw = data.tobytes()
            wanted = batch.column(2)
            flat = wanted.flatten()
            counts = np.asarray(wanted.value_lengths())
            doc = np.repeat(np.arange(len(counts)), counts)
            place = flat.field("place").to_numpy()
            stretch = flat.field("stretch").to_numpy().view(np.uint64)
            begin = offsets[doc] + (place & 0xFFFFFFFF)
            end = begin + ((stretch >> np.uint64(8)) & np.uint64(255)).astype(np.int64) + window - 1
            parts = pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
            columns = [flat.field("anchor"), flat.field("stretch"), batch.column(0).take(pa.array(doc)), flat.field("place"), flat.field("seen"), flat.field("kinds"), parts]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return held.mapInArrow(run, "anchor long, stretch long, doc_id long, place long, seen long, kinds long, bytes binary")


SPANS = "doc_id long, place long, windows_from int, windows_to int"
SPAN_NAMES = ["doc_id", "place", "windows_from", "windows_to"]


def sorted_groups(rows: DataFrame, window: int) -> DataFrame:
    """Repeated windows of the stretches that were seen once, from suffix sorting in their groups."""

    def resolve(table: pa.Table) -> pa.RecordBatch:
        anchor = table["anchor"].to_numpy()
        stretch = table["stretch"].to_numpy().view(np.uint64)
        many = ((stretch >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
        first = (stretch & np.uint64(255)).astype(np.int64)
        _, group = np.unique(anchor, return_inverse=True)
        seen = table["seen"].to_numpy()
        flags = repeated_windows(group, first, many, seen, table["bytes"].to_pylist(), window)
        spans = [(i, a, b) for i, f in enumerate(flags) if seen[i] == 1 for a, b in runs(f)]
        at = pa.array([s[0] for s in spans], pa.int64())
        ids, places = table["doc_id"].combine_chunks().take(at), table["place"].combine_chunks().take(at)
        return pa.RecordBatch.from_arrays([ids, places, pa.array([s[1] for s in spans], pa.int32()), pa.array([s[2] for s in spans], pa.int32())], names=SPAN_NAMES)

    def run(batches):
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n < LOT:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            last = table["anchor"].to_numpy()
            cut = int(np.searchsorted(last, last[-1]))  # the last group may go on
            if cut:
                yield resolve(table.slice(0, cut))
            waiting = table.slice(cut).to_batches()
            n -= cut
        if n:
            yield resolve(pa.Table.from_batches(waiting).combine_chunks())

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, SPANS)


def cells(rows: DataFrame, step: int, window: int) -> DataFrame:
    """Rows cut into stretches of ``step`` windows, with the digest of what all windows of one share as their anchor.

    Windows that are equal fall into equal places of cells with an equal anchor, as
    cells are counted from the old anchor.
    """
    names = ["anchor", "stretch", "doc_id", "place", "seen", "bytes"]

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(4).cast(pa.large_binary()).view(pa.large_string()))
            if not len(data):
                continue
            first = (batch.column(0).to_numpy().view(np.uint64) & np.uint64(255)).astype(np.int64)
            many = np.diff(offsets) - window + 1
            # A window's cell: how many steps the anchor lies behind it.
            row = np.repeat(np.arange(len(many)), many)
            number = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            cell = (first[row] - number) // step
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(row)))
            row, number, cell = row[at], number[at], cell[at]
            # The bytes that all windows of the cell share; every one of them holds these, so each row has them.
            last = first[row] - cell * step
            begin, end = offsets[row] + number, offsets[row] + number + size + window - 1
            core = offsets[row] + last, offsets[row] + last - step + 1 + window
            anchor = Prefix(data).hash(*core)
            whole = Prefix(data, OTHER_BASE).hash(begin, end)
            raw = data.tobytes()
            stretch = (whole >> np.uint64(16) << np.uint64(16)) | (size.astype(np.uint64) << np.uint64(8)) | (last - number).astype(np.uint64)
            parts = pa.array([raw[x:y] for x, y in zip(begin.tolist(), end.tolist())], pa.binary())
            at = pa.array(row)
            columns = [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column(1).take(at), pa.array(batch.column(2).to_numpy()[row] + number), batch.column(3).take(at), parts]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("stretch", "doc_id", "place", "seen", "bytes").mapInArrow(run, "anchor long, stretch long, doc_id long, place long, seen long, bytes binary")


def last_window() -> Column:
    return F.shiftright("stretch", 8).bitwiseAND(255).cast("int") - 1


def resolved(rows: DataFrame, window: int, together: int, steps: tuple[int, ...]) -> DataFrame:
    """Spans of repeated windows of ``rows``: different stretches of anchors with several, with their bytes.

    Groups beyond ``together`` are cut into cells of ``steps[0]`` windows and what is
    left of those likewise; a cell of one window is a group of one kind.
    """
    rows = rows.select("anchor", "stretch", "doc_id", "place", "seen", "bytes", "kinds")
    spans = sorted_groups(rows.where(F.col("kinds") <= together), window)
    hot = rows.where(F.col("kinds") > together)
    if not steps or hot.isEmpty():
        return spans
    cut = stored(cells(hot, steps[0], window), "cells")
    same = ["anchor", "stretch"]
    kinds = cut.groupBy(*same).agg(F.sum("seen").alias("seen"), F.first(F.struct("doc_id", "place", "bytes")).alias("one"))
    kinds = stored(kinds.select(*same, "seen", "one.*"), "cell-kinds")
    several = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "cell-groups")
    whole = cut.where("seen = 1").join(kinds.where("seen > 1").select(*same), same)
    whole = whole.select("doc_id", "place", F.lit(0).alias("windows_from"), last_window().alias("windows_to"))
    return spans.union(whole).union(resolved(kinds.join(several, "anchor"), window, together, steps[1:]))


def repeated_spans(docs: DataFrame, window: int = WINDOW, core: int = CORE, together: int = SORTED_TOGETHER) -> DataFrame:
    """(doc_id, mark, spans) of documents with repeats: byte ranges, which may overlap."""
    same = ["anchor", "stretch"]
    found = anchored(docs, window, core)
    # Counts are written tables, so that joins with them can be split where an anchor is frequent.
    twice = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "frequent")
    again = stored(found.join(twice, "anchor"), "anchors")
    kinds = again.groupBy(*same).agg(F.count("*").alias("seen"), F.first(F.struct("doc_id", "place")).alias("one"))
    kinds = stored(kinds.select(*same, "seen", "one.doc_id", "one.place"), "stretches")
    whole = again.join(kinds.where("seen > 1").select(*same), same)
    whole = whole.select("doc_id", "place", F.lit(0).alias("windows_from"), last_window().alias("windows_to"))
    different = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "groups")
    held = bytes_of(kinds.join(different, "anchor"), docs, window)
    # Rows of one id and text fetch the same bytes; one is enough.
    held = stored(held.dropDuplicates(same), "bytes")
    spans = whole.union(resolved(held, window, together, CELLS))
    begin = F.col("place").bitwiseAND(0xFFFFFFFF)
    return (
        spans.select("doc_id", F.shiftright("place", 32).cast("int").alias("mark"), (begin + F.col("windows_from")).alias("a"), (begin + F.col("windows_to") + window).alias("b"))
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, window: int = WINDOW, core: int = CORE, together: int = SORTED_TOGETHER) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and kept (the bytes that stay) of every row.

    A null text has no bytes. Rows that repeat are documents of their own, so they
    remove each other. Texts shorter than the window stay. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    mark = F.xxhash64(text_of(docs)).bitwiseAND(0x7FFFFFFF).cast("int")
    rows = docs.select("doc_id", mark.alias("mark"), text_of(docs).alias("text"))
    # All of a row that repeats goes, and one of its rows stands for all when others are compared with it.
    again = stored(rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "mark"), "rows")
    searched, repeats = rows, not again.isEmpty()
    if repeats:
        known = rows["doc_id"].eqNullSafe(again["doc_id"]) & (rows["mark"] == again["mark"])
        one = rows.join(again, known, "left_semi").dropDuplicates(["doc_id", "mark"])
        searched = stored(rows.join(again, known, "left_anti").union(one), "searched")
    spans = repeated_spans(searched, window, core, together)
    same = rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["mark"] == spans["mark"])
    joined = rows.join(spans, same, "left").select(rows["doc_id"], rows["mark"], "text", "spans")
    if repeats:
        flagged = again.select(F.col("doc_id").alias("id"), F.col("mark").alias("of"), F.lit(True).alias("whole"))
        joined = joined.join(flagged, joined["doc_id"].eqNullSafe(flagged["id"]) & (joined["mark"] == flagged["of"]), "left")
    joined = joined.select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)) if repeats else F.lit(False))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            raw, kept, found = data.tobytes(), [], []
            for a, b, spans, whole in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                runs_ = [(0, b - a)] if whole and b - a >= window else merged([(s["a"], s["b"]) for s in spans or ()])
                found.append(runs_)
                edges = [0, *(x for r in runs_ for x in r), b - a]
                kept.append(b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])))
            size = np.diff(offsets)
            left = np.array([len(k) for k in kept], np.int64)
            columns = [
                batch.column(0), pa.array(size), pa.array(size - left), pa.array([len(f) for f in found], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                pa.array([[{"a": a, "b": b} for a, b in f] for f in found], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a:long,b:long>>, kept binary"
    return joined.mapInArrow(run, schema)
