"""Line dedup by a tree of log templates, with DataFrame functions only.

Every line goes down a tree of fixed depth: its number of tokens, then its leading
tokens; tokens with a digit are a variable field on every level. Inside a leaf a
template is the whole line or, for lines of nine tokens or more, any two of its three
sections with the third one variable, so lines of a template share two thirds of
their tokens in place. A template found in several documents recurs: its lines stay in
the document of the least doc_id and are dropped from all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, stored, text_of

#: Shorter lines are left alone; lines from `SECTIONED` tokens on may vary in a section.
LEAST_TOKENS, SECTIONED, DEPTH = 4, 9, 3
FIELD = "<*>"


def row_mark() -> Column:
    """With doc_id it tells rows of the same id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def lines(docs: DataFrame, least: int = LEAST_TOKENS, depth: int = DEPTH) -> DataFrame:
    """doc_id, mark, line (from 0), leaf and the hashes of the three sections of each line with enough tokens."""
    plain = F.regexp_replace(text_of(docs), r"(?<!\S)[^\s0-9]*+[0-9]\S*+", FIELD)
    rows = docs.select("doc_id", row_mark().alias("mark"), F.posexplode(F.split(plain, "\n")).alias("line", "masked"))
    # Trimmed of all white space first: a line's tokens are what stands between.
    masked = F.regexp_replace(F.regexp_replace("masked", r"^\s+|\s+$", ""), r"\s+", " ")
    rows = rows.withColumn("tokens", F.split(masked, " ")).withColumn("n", F.size("tokens")).where(F.col("n") >= least)
    third = F.floor(F.col("n") / 3).cast("int")
    section = lambda begin, size: F.xxhash64(F.slice("tokens", begin, size))
    return rows.select(
        "doc_id", "mark", "line", "n",
        F.xxhash64("n", F.slice("tokens", 1, depth)).alias("leaf"),
        section(F.lit(1), third).alias("s1"),
        section(third + 1, third).alias("s2"),
        section(2 * third + 1, F.col("n") - 2 * third).alias("s3"),
    )


def repeats(docs: DataFrame, least: int = LEAST_TOKENS, depth: int = DEPTH, sectioned: int = SECTIONED) -> DataFrame:
    """(doc_id, mark, dropped): the numbers of the lines to drop, for each document that has some."""
    spark = docs.sparkSession
    found = stored(lines(docs, least, depth), "lines")
    # Null ids come first; only lines of leaves with several documents go on.
    number = F.coalesce("doc_id", F.lit(-(2**63)))
    found = found.withColumn("number", number)

    def several(df: DataFrame, key: str) -> DataFrame:
        """Keys of several documents. A written table, so that the join with it can be split where a key is frequent."""
        ends = df.groupBy(key).agg(F.min("number").alias("first"), F.max("number").alias("last"))
        return stored(ends.where("first < last").select(key, "first"), f"several-{key}")

    shared = found.join(several(found, "leaf").drop("first"), "leaf")
    whole = F.xxhash64(F.lit(0), "leaf", "s1", "s2", "s3")
    parts = [F.xxhash64(F.lit(i + 1), "leaf", *(s for j, s in enumerate(("s1", "s2", "s3")) if j != i)) for i in range(3)]
    templates = F.when(F.col("n") >= sectioned, F.array(whole, *parts)).otherwise(F.array(whole))
    keyed = stored(shared.select("doc_id", "mark", "line", "number", templates.alias("templates")), "templates")
    placed = keyed.select("doc_id", "mark", "line", "number", F.explode("templates").alias("template"))
    later = placed.join(several(placed, "template"), "template").where("number > first")
    # A line meets up to four templates: one row for each line, then one for each document.
    return later.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("dropped"))


def without_repeats(docs: DataFrame, **tree) -> DataFrame:
    """``docs`` without the lines of recurring templates, with the columns of ``docs`` and then n_lines and n_dropped.

    A null text stays null and has no lines; lines of white space and short ones stay.
    Rows of one doc_id are one document. A document may end up empty. n_chars, if there is one,
    follows a text that changed. An empty table gives no rows.
    """
    names = docs.columns
    taken = {c.lower() for c in names}
    id_name, mark, lines_name = free_names(docs, "dropped_id", "dropped_mark", "dropped_lines")
    drops = repeats(docs.select("doc_id", "text"), **tree)
    drops = drops.select(F.col("doc_id").alias(id_name), F.col("mark").alias(mark), F.col("dropped").alias(lines_name))
    same = docs["doc_id"].eqNullSafe(drops[id_name]) & (row_mark() == drops[mark])
    joined = docs.join(drops, same, "left")
    split = F.split(joined["text"], "\n")
    left = F.filter(split, lambda _, i: ~F.array_contains(joined[lines_name], i))
    changed = joined[lines_name].isNotNull()
    text = F.when(changed, F.array_join(left, "\n")).otherwise(joined["text"])
    columns = []
    for c in names:
        old = joined[f"`{c}`"]
        if c == "text":
            columns.append(text.alias(c))
        elif c == "n_chars":
            columns.append(F.when(changed, F.char_length(text).cast(dict(docs.dtypes)[c])).otherwise(old).alias(c))
        else:
            columns.append(old)
    counts = [
        F.coalesce(F.size(split), F.lit(0)).alias("n_lines") if "n_lines" not in taken else None,
        F.when(changed, F.size(lines_name)).otherwise(0).alias("n_dropped") if "n_dropped" not in taken else None,
    ]
    return joined.select(*columns, *[c for c in counts if c is not None])


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, the text that stays, n_lines and n_dropped of every row."""
    return without_repeats(docs.select("doc_id", "text"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines of recurring templates."""
    return without_repeats(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
