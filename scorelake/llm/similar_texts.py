"""Groups of texts that share four fifths of their five-word shingles.

A text gets the minima of its shingles' hashes under 128 functions, in 32 bands of
four. Two texts of similarity 0.8 agree in no band with a chance of 5 in 10**8, less
if they are more alike. Texts also meet by `near_copies`: multi-index hashing finds the
SimHash fingerprints within two bits, and those that lead to each other are a bucket like
that of a band. The rule itself is checked exactly, on whole sets of shingles.

Equal sequences of words are one vertex. In each bucket all members are
compared with the one that meets the most others. Where that leaves a bucket in
several groups, its members outside its largest group look for partners, but only
where sizes allow one: sets of a and b shingles must share 4/9 (a + b), and a set
shares at most those of its shingles that any other undecided set has. So two texts with
more than a ninth of their shingles to themselves are never paired, in whatever bucket
they meet; in a large group of copies that are each edited in their own way, which are alike
to the original only, nothing is left to compare. Pairs meet by bucket and class of
size, so those that sizes rule out are not made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Prefix, buffers, mix, passes, ship, stored, text_of, words_of
from .contamination import FACTOR
from .near_copies import LOWER, components, fingerprint, first_of_groups, links as near_links

SHINGLE = 5
BANDS, ROWS = 32, 4
#: Classes of sizes grow by this factor.
SIZE_STEP = 1.04
#: An odd factor and a summand for each hash function.
FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * FACTOR) | np.uint64(1)
SUMMANDS = mix(FACTORS)


def grams_of(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the first word of each text; of their shingles, and the first shingle of each.

    A text of fewer words is one shingle; a text without words has none.
    """
    starts, ends, bounds = words_of(data, offsets)
    words = Prefix(LOWER[data]).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    counts = np.diff(bounds)
    grams = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(grams)])
    at = np.repeat(bounds[:-1] - first[:-1], grams) + np.arange(first[-1])
    end = np.repeat(bounds[1:], grams)
    out = np.zeros(first[-1], np.uint64)
    for i in range(size):
        inside = at + i < end
        out[inside] = out[inside] * FACTOR + words[at[inside] + i]
    return words, bounds, mix(out), first


def bands(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: the digest of its words in order, and the key of each band. All 0 for a text without words."""
    out = np.zeros((len(offsets) - 1, BANDS + 1), np.uint64)
    words, bounds, grams, first = grams_of(data, offsets)
    filled = np.flatnonzero(np.diff(first))
    if not len(filled):
        return out
    place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
    out[filled, 0] = np.add.reduceat(mix(words + mix(place.astype(np.uint64))), bounds[:-1][filled])
    for b in range(BANDS):
        key = np.full(len(filled), b, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key * FACTOR + np.minimum.reduceat(grams * FACTORS[k] + SUMMANDS[k], first[:-1][filled]))
        out[filled, b + 1] = key
    return out


def band_keys(text: Column) -> Column:
    """Digest and band keys of a column of texts."""

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        parts = [bands(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in passes(offsets)]
        flat = np.concatenate(parts).reshape(-1).view(np.int64) if parts else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * (BANDS + 1)), pa.array(flat))

    return run(text)


def gram_sets(text: Column) -> Column:
    """The different shingles of a column of texts, as hashes."""

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        rows = []
        for i, j in passes(offsets):
            _, _, grams, first = grams_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            rows += [np.unique(grams[a:b]).view(np.int64) for a, b in zip(first, first[1:])]
        return pa.array(rows, pa.list_(pa.int64()))

    return run(text)


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (fp, least) whose sets (fp, grams) have a similarity of 0.8 or more."""
    one, other = (sets.select(F.col("fp").alias(c), F.col("grams").alias(f"{c}_grams")) for c in ("fp", "least"))
    both = pairs.join(one, "fp").join(other, "least")
    shared = F.size(F.array_intersect("fp_grams", "least_grams"))
    # shared / (a + b - shared) >= 4 / 5, in whole numbers.
    return both.where(9 * shared >= 4 * (F.size("fp_grams") + F.size("least_grams"))).select("fp", "least")


def size_class(size: Column) -> Column:
    return F.floor(F.log(size) / F.log(F.lit(SIZE_STEP))).cast("int")


def undecided_pairs(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (fp, least) of a bucket of ``placed`` (entry, fp, root) that are in different groups and can be similar."""
    # Buckets in several groups, and the largest group of each.
    groups = placed.groupBy("entry", "root").agg(F.count("*").alias("n"))
    largest = groups.groupBy("entry").agg(F.count("*").alias("groups"), F.max(F.struct("n", "root")).alias("m"))
    split = stored(largest.where("groups > 1").select("entry", F.col("m.root").alias("largest")), "split")
    left = stored(placed.join(split, "entry"), "left")
    # How many shingles each has, and how many of them another one has too.
    known = stored(sets.join(left.select("fp").distinct(), "fp"), "undecided")
    single = known.select("fp", F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"), F.min("fp").alias("fp"))
    own = single.where("n = 1").groupBy("fp").agg(F.count("*").alias("own"))
    sizes = known.select("fp", F.size("grams").alias("size")).join(own, "fp", "left")
    sizes = stored(sizes.select("fp", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common")), "sizes")
    # Partners of a set: 5 * smaller >= 4 * larger, and 4 * (size + other) <= 9 * common.
    least = F.ceil(F.col("size") * 4 / 5)
    most = F.least(F.floor(F.col("size") * 5 / 4), F.floor((9 * F.col("common") - 4 * F.col("size")) / 4))
    members = left.join(sizes, "fp").withColumns({"from": least, "to": most}).where("`from` <= `to`")
    members = stored(members, "members")
    seekers = members.where("root != largest").withColumn("class", F.explode(F.sequence(size_class(F.col("from")), size_class(F.col("to")))))
    held = members.select("entry", size_class(F.col("size")).alias("class"), *(F.col(c).alias(f"other_{c}") for c in ("fp", "root", "size", "from", "to")))
    meets = "root != other_root AND other_size BETWEEN `from` AND `to` AND size BETWEEN other_from AND other_to"
    # Both may seek each other.
    once = "(other_root = largest OR fp < other_fp)"
    met = seekers.join(held, ["entry", "class"]).where(f"{meets} AND {once}")
    return met.select(F.greatest("fp", "other_fp").alias("fp"), F.least("fp", "other_fp").alias("least")).distinct()


def with_near_copies(values: DataFrame) -> DataFrame:
    """``values`` (fp, row, keys, print) with one more key: the group of near copies of the fingerprint ``print``, if it has others."""
    prints = stored(values.groupBy(F.col("print").alias("fp")).agg(F.count("*").alias("n")), "prints")
    groups = prints.join(components(near_links(prints.select("fp"))), "fp", "left")
    groups = groups.where("n > 1 OR root IS NOT NULL").select(F.col("fp").alias("print"), F.coalesce("root", "fp").alias("root"))
    # A written table, so that the join with it can be split where a fingerprint has very many texts.
    found = values.join(stored(groups, "near-groups"), "print", "left")
    group = F.xxhash64(F.lit("near copies"), "root")
    return found.select("fp", "row", F.when(F.col("root").isNull(), F.col("keys")).otherwise(F.concat("keys", F.array(group))).alias("keys"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """doc_id, mark (digest of the text) and root (the same for all of a group) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    mark = F.xxhash64(text_of(docs))
    rows = docs.select("doc_id", mark.alias("mark"), band_keys(text_of(docs)).alias("keys"), fingerprint(text_of(docs)).alias("print"))
    marked = stored(rows.select("doc_id", "mark", F.col("keys")[0].alias("fp"), F.slice("keys", 2, BANDS).alias("keys"), "print"), "bands")
    # One row for each vertex, with the row whose text stands for it.
    key = F.struct("doc_id", "mark")
    values = marked.where("fp != 0").groupBy("fp").agg(F.min(F.struct(key.alias("row"), "keys", "print")).alias("v")).select("fp", "v.*")
    values = stored(with_near_copies(stored(values, "distinct")), "vertices")
    entries = values.select("fp", F.explode("keys").alias("entry"))
    # Written tables, so that joins with them can be split where a bucket is large.
    several = stored(entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1"), "several")
    shared = stored(entries.join(several, "entry").select("entry", "fp", "n"), "buckets")
    degree = stored(shared.groupBy("fp").agg(F.sum("n").alias("degree")), "degrees")
    # Sets of the vertices that share a bucket only.
    wanted = degree.select("fp").join(values.select("fp", F.col("row.doc_id").alias("id"), F.col("row.mark").alias("digest")), "fp")
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["id"]) & (mark == wanted["digest"]))
    sets = stored(found.dropDuplicates(["fp"]).select("fp", gram_sets(F.col("text")).alias("grams")), "sets")

    centres = shared.join(degree, "fp").groupBy("entry").agg(F.max(F.struct("degree", "fp")).alias("c")).select("entry", F.col("c.fp").alias("least"))
    first = shared.join(stored(centres, "centres"), "entry").where("fp != least").select("fp", "least").distinct()
    links = stored(alike(first, sets), "links")
    roots = stored(components(links), "roots")
    placed = shared.join(roots, "fp", "left").select("entry", "fp", F.coalesce("root", "fp").alias("root"))
    rest = undecided_pairs(stored(placed, "placed"), sets)
    links = links.union(stored(alike(rest, sets), "links"))
    roots = stored(components(links), "roots")
    return marked.join(roots, "fp", "left").select("doc_id", "mark", F.coalesce("root", "fp").alias("root"))


def keep_one_similar(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each group: its least doc_id, of repeated ids the least digest of the text.

    Near copies and others that may be alike are compared. Texts are in one group if pairs with a Jaccard similarity of 0.8 or more, of their
    sets of five lower-case words in a row, lead from one to the other. A text of fewer words is
    one shingle; null and texts without words are one group. An empty table gives no rows.
    """
    return first_of_groups(docs, similar_groups(docs.select("doc_id", "text")))
