"""SimHash near-duplicate groups by multi-index hashing.

A fingerprint is cut into two segments, and a table for each segment lists the fingerprints
by the segment's value. If two fingerprints differ in two bits at most, they are equal in
the second segment or differ in one bit at most in the first. So every fingerprint
looks up the ball of radius one around its first segment and the very value of its
second, 34 entries of the tables, and what it finds is verified on the whole fingerprint.

A value that many fingerprints share would make a hot entry. Its fingerprints, and all
that look it up, are met by the other segment as well: there the key is the whole
fingerprint with at most one bit changed, so that an entry holds at most 65
fingerprints. No match is missed. Equal fingerprints are one vertex. Groups
are connected components by alternating large and small stars on written tables.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, free_names, passes, ship, stored, text_of, words_of

BITS, SEGMENTS, RADIUS = 64, 2, 2
#: Fingerprints of an entry of a table; entries with more are met by whole fingerprints.
TOGETHER = 64
SEED = 42
SHINGLE = 3

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE) -> np.ndarray:
    """SimHash of each text as an unsigned 64-bit number; 0 for a text without words."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    starts, ends, bounds = words_of(data, offsets)
    if not len(starts):
        return out
    data = LOWER[data]
    # Words joined by one space, all texts in a row.
    sizes = ends - starts
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(begin[-1], 32, np.uint8)
    source = np.repeat(starts - begin[:-1], sizes + 1) + np.arange(begin[-1])
    letters = np.ones(begin[-1], bool)
    letters[begin[1:] - 1] = False
    joined[letters] = data[source[letters]]
    raw = joined.tobytes()
    counts = np.diff(bounds)
    grams = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
    filled = np.flatnonzero(grams)
    first_gram = np.concatenate([[0], np.cumsum(grams)])
    first = np.repeat(bounds[:-1] - first_gram[:-1], grams) + np.arange(first_gram[-1])
    last = np.minimum(first + words, np.repeat(bounds[1:], grams))
    digest = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    hashes = np.fromiter(
        map(digest, map(raw.__getitem__, map(slice, begin[first].tolist(), (begin[last] - 1).tolist()))), np.uint64, len(first)
    )
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, first_gram[:-1][filled], axis=0, dtype=np.int32)
    major = 2 * ones > grams[filled][:, None]
    out[filled] = np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def fingerprint(text: Column, words: int = SHINGLE) -> Column:
    """SimHash of a column of texts, its 64 bits as a long."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        parts = [fingerprints(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words) for i, j in passes(offsets)]
        return pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))

    return run(text)


def signed(n: int) -> int:
    return n - (1 << BITS) if n >> (BITS - 1) else n


def balls(radius: int = RADIUS, segments: int = SEGMENTS) -> list[list[int]]:
    """For each segment, the masks of the ball of its values to look up, as signed numbers.

    With radius = q * segments + a, values within ``radius`` are within q in one of the first a + 1 segments or within q - 1 in another.
    """
    q, a = divmod(radius, segments)
    width = BITS // segments
    out = []
    for k in range(segments):
        most = q if k <= a else q - 1
        bits = range(k * width, (k + 1) * width)
        out.append([signed(sum(1 << b for b in chosen)) for n in range(most + 1) for chosen in itertools.combinations(bits, n)])
    return out


def dealt(values: DataFrame) -> DataFrame:
    """Each row becomes many, so the rows are dealt out to all tasks first."""
    return values.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def links(values: DataFrame, radius: int = RADIUS, together: int = TOGETHER) -> DataFrame:
    """Pairs (fp, least) that join all fingerprints of ``values`` (distinct ``fp``) within ``radius`` of each other.

    Not all pairs: in a hot entry every member is linked to the least one.
    """
    if radius != 2:
        raise ValueError("hot entries are met by balls of radius one, which reach a distance of two")
    width = BITS // SEGMENTS
    part = lambda k, x: x.bitwiseAND(F.lit(signed(((1 << width) - 1) << (k * width))))
    fp = F.col("fp")
    held = values.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("segment"), part(k, fp).alias("value")) for k in range(SEGMENTS)])).alias("e"))
    held = held.select("fp", "e.*")
    entry = ["segment", "value"]
    sizes = stored(held.groupBy(*entry).agg(F.count("*").alias("n")), "entries")
    # Spark sizes a frame as before its explode, and would send it to the driver to be broadcast.
    small = held.hint("merge").join(sizes.where(F.col("n") <= together).select(*entry), entry).groupBy(*entry).agg(F.collect_list("fp").alias("members"))
    hot = sizes.where(F.col("n") > together).select(*entry, F.lit(None).cast("array<long>").alias("members"))
    tables = stored(small.unionByName(hot), "segment-tables")

    masks = [(k, m) for k, ball in enumerate(balls(radius)) for m in ball]
    looks = F.explode(F.array(*[F.struct(F.lit(k).alias("segment"), F.lit(m).cast("long").alias("mask")) for k, m in masks])).alias("l")
    looks = dealt(values).select("fp", looks).select("fp", "l.segment", "l.mask")
    value = F.coalesce(*[F.when(F.col("segment") == k, part(k, fp)) for k in range(SEGMENTS)])
    looks = looks.select("fp", "segment", value.bitwiseXOR(F.col("mask")).alias("value"))
    near = F.filter("members", lambda other: (other != F.col("fp")) & (F.bit_count(other.bitwiseXOR(F.col("fp"))) <= radius))
    met = looks.hint("merge").join(tables, entry).select("fp", near.alias("near"), F.col("members").isNull().alias("hot"))
    met = stored(met.where(F.col("hot") | (F.size("near") > 0)), "met")
    found = met.where("NOT hot").select("fp", F.explode("near").alias("other"))
    pairs = found.select(F.greatest("fp", "other").alias("fp"), F.least("fp", "other").alias("least"))
    return pairs.union(linked_by_neighbours(met.where("hot").select("fp").distinct(), radius)).distinct()


def linked_by_neighbours(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`links` by entries of whole fingerprints: each stands in those of the 65 values within one bit of it."""
    masks = F.array(*[F.lit(signed(1 << b)).cast("long") for b in range(BITS)], F.lit(0).cast("long"))
    entries = dealt(values).select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("entry"))
    table = entries.groupBy("entry").agg(F.min("fp").alias("least"), F.max("fp").alias("most"), F.collect_set("fp").alias("members"))
    met = table.where(F.col("least") != F.col("most")).select("least", F.explode("members").alias("fp")).where("fp != least")
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= radius).select("fp", "least")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for each vertex of ``edges`` (fp, least): the least vertex that can be reached.

    Alternating stars: each round links the larger neighbours of a vertex, then the
    smaller ones, to the least vertex around it. No vertex collects its neighbours,
    and every round is a written table. Done when nothing changes.
    """
    now = stored(edges.select(F.greatest("fp", "least").alias("u"), F.least("fp", "least").alias("v")), "edges")

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = pairs
        # A written table, so that the join with it can be split where a vertex has very many neighbours.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least")
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    mark = None
    while True:
        now = stored(star(star(now, True), False), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    roots = now.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())


def with_groups(docs: DataFrame) -> DataFrame:
    """doc_id, mark (digest of the text), fp, root (one fingerprint of the group) and component_id of every row.

    component_id is the least doc_id of the group; a null id counts only if the group has no other.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64(text_of(docs)).alias("mark"), fingerprint(text_of(docs)).alias("fp"))
    marked = stored(rows, "fingerprints")
    values = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "values")
    roots = components(links(values.select("fp")))
    named = values.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "roots")
    first = stored(named.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    known = named.select("fp", "root").join(first, "root")
    return marked.join(known, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    A null text counts as empty; texts without words have fingerprint 0 and are linked
    like any other. Rows that repeat are one vertex, reported each. An empty table gives no rows.
    """
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return with_groups(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the first one of each root of ``found`` (doc_id, mark, root)."""
    names = docs.columns
    # A null id stands behind all others.
    order = found.select("root", F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", "mark").alias("key"))
    id_name, digest = free_names(docs, "kept_id", "kept_digest")
    kept = order.groupBy("root").agg(F.min("key").alias("key")).select(F.col("key.doc_id").alias(id_name), F.col("key.mark").alias(digest))
    mark = F.xxhash64(text_of(docs))
    held = docs.join(kept, docs["doc_id"].eqNullSafe(kept[id_name]) & (mark == kept[digest]))
    return held.dropDuplicates([id_name, digest]).select(*[F.col(f"`{c}`") for c in names])
