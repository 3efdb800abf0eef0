"""Scripts made of ordered paragraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default mark, and the form of a mark line.
DEFAULT_MARK = "pyspark"
MARK = r"%[\w.]+\s*\n"
#: A mark of any paragraph but the first is commented out with "#".
LATER_START = rf"\n(?=[ \t]*#+{MARK})"
FIRST_START = rf"\n(?=#*{MARK})"


def assemble_documents(
    df: DataFrame, doc: str, index: str, text: str, sep: str = "\n", part_size: int | None = 10_000
) -> DataFrame:
    """Join the paragraphs of each document in order: ``(doc, paragraphs, script)``.

    A line ``%name`` becomes ``#%name``. Text is rewritten before the shuffle.
    Paragraphs are first put in order and joined in parts of `part_size` index
    values, by as many tasks as a long document has parts; the parts are then
    joined to the script, one row per document for any `part_size`.
    Null texts are left out of the script, but counted.
    """
    part = F.lit(0).cast("bigint") if part_size is None else F.floor(F.col(index) / F.lit(part_size)).cast("bigint")
    marked = F.regexp_replace(F.col(text), rf"\s*({MARK})", "#$1")
    paragraphs = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), marked.alias("t"))))
    parts = (
        df.groupBy(F.col(doc).alias("d"), part.alias("part"))
        .agg(paragraphs.alias("p"))
        .select(
            "d",
            "part",
            F.size("p").cast("bigint").alias("n"),
            # A part of null texts only adds nothing, not even a separator.
            F.when(F.exists("p.t", lambda t: t.isNotNull()), F.concat_ws(sep, F.col("p.t"))).alias("t"),
        )
    )
    scripts = F.array_sort(F.collect_list(F.struct("part", "t")))
    return (
        parts.groupBy("d")
        .agg(F.sum("n").alias("paragraphs"), scripts.alias("s"))
        .select(F.col("d").alias(doc), "paragraphs", F.concat_ws(sep, F.col("s.t")).alias("script"))
    )


def split_documents(
    df: DataFrame, doc: str | list[str], text: str, default_mark: str | None = DEFAULT_MARK
) -> DataFrame:
    """Cut scripts into paragraphs: ``(doc, index, paragraph)``, numbered from 0.

    A line ``#%name`` starts a paragraph and loses its ``#``; before the first
    such line a plain ``%name`` line does too. Text before the first mark is a
    paragraph of its own, empty pieces are dropped, and a paragraph without any
    mark gets ``%<default_mark>``. A projection: no shuffle.
    """
    keys = [doc] if isinstance(doc, str) else list(doc)
    pieces = F.split(F.col(text), LATER_START)
    # The first piece may hold one plain mark: cut there, once.
    head = F.split(F.get(pieces, F.lit(0)), FIRST_START, 2)
    unmarked = F.transform(
        F.concat(F.slice(head, 2, 1), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))),
        lambda p: F.regexp_replace(p, rf"^[ \t]*#*(?={MARK})", ""),
    )
    texts = F.filter(F.concat(F.slice(head, 1, 1), unmarked), lambda p: F.length(p) > 0)
    rows = df.select(*keys, F.posexplode(texts).alias("index", "paragraph"))
    if default_mark:
        has_mark = F.col("paragraph").rlike(r"%[a-zA-Z0-9_.]+\s*\n")
        marked = F.concat(F.lit(f"%{default_mark}\n"), F.col("paragraph"))
        rows = rows.withColumn("paragraph", F.when(has_mark, F.col("paragraph")).otherwise(marked))
    return rows.withColumn("index", F.col("index").cast("bigint"))
