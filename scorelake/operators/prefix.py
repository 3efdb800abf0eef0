"""Running sums and row numbers over a global order, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import settled, written
from .cells import ROWS_PER_CELL, CutTree, cell_of

#: Numbers of copies that one row is turned into at a time.
COPIES_PER_BLOCK = 100_000


def prefix_sums(
    points: DataFrame,
    order: str,
    values: list[str],
    keys: list[str] | None = None,
    descending: bool = False,
    cuts: list[float] | None = None,
    lead: bool = False,
    cell: Column | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` and ``total_<v>`` per key, in the order of a column.

    `points` holds at most one row per key and order value (group first). With
    `cuts`, rows are put in cells by value, each cell is summed by its own task
    and the totals of the cells before it are added: a two-level prefix sum.
    `cell` may give the cells themselves, as numbers that rise along the order.
    With `lead`, ``next_<v>`` holds the value of the following row. The cell
    stays in the result as ``_cell``.
    """
    keys = list(keys or [])
    direction = F.desc if descending else F.asc
    if cell is not None:
        points = points.withColumn("_cell", cell)
    elif cuts:
        number = F.expr(cell_of(order, cuts))
        points = points.withColumn("_cell", (F.lit(2 * len(cuts)) - number) if descending else number)
    else:
        points = points.withColumn("_cell", F.lit(0))
    inside = Window.partitionBy(*keys, "_cell").orderBy(direction(order))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = points.select(
        "*",
        *[F.sum(v).over(running).alias(f"cum_{v}") for v in values],
        *([F.lead(v).over(inside).alias(f"next_{v}") for v in values] if lead else []),
    )
    if not cuts and cell is None:
        whole = Window.partitionBy(*keys, "_cell")
        return summed.select("*", *[F.sum(v).over(whole).alias(f"total_{v}") for v in values])

    # One row per key and cell; the number of cells is bounded by the cuts.
    first = F.max_by if descending else F.min_by
    cells = points.groupBy(*keys, "_cell").agg(
        *[F.sum(v).alias(f"sum_{v}") for v in values],
        *([first(F.struct(*values), order).alias("first")] if lead else []),
    )
    per_key = [*keys] or [F.lit(0)]
    before = Window.partitionBy(*per_key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*per_key)
    following = Window.partitionBy(*per_key).orderBy("_cell")
    offsets = cells.select(
        *keys,
        "_cell",
        *[F.coalesce(F.sum(f"sum_{v}").over(before), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"sum_{v}").over(whole).alias(f"total_{v}") for v in values],
        *([F.lead("first").over(following).alias("_first")] if lead else []),
    )
    # Keys may be null, and a null key is a group like any other.
    renamed = offsets.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)} | {"_cell": "_cell_of"})
    same = summed["_cell"] == renamed["_cell_of"]
    for i, k in enumerate(keys):
        same = same & summed[k].eqNullSafe(renamed[f"_key{i}"])
    joined = summed.join(renamed, same).drop("_cell_of", *[f"_key{i}" for i in range(len(keys))])
    joined = joined.withColumns({f"cum_{v}": F.col(f"cum_{v}") + F.col(f"_before_{v}") for v in values})
    if lead:
        joined = joined.withColumns(
            {f"next_{v}": F.coalesce(F.col(f"next_{v}"), F.col(f"_first.{v}")) for v in values}
        )
    return joined.drop("_first", *[f"_before_{v}" for v in values])


def row_numbers(
    df: DataFrame, order_by: list[str], name: str = "row_number", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Number all rows from 1 by a given order, with every task sorting its own range.

    Rows are put in cells by their order columns and a digest of the row, so neither a hot key nor
    an uneven column makes a cell large. The cuts between cells form a tree of two levels,
    of which the plan holds the first, at most 255 rows, and a small table the second. Rows
    with very many copies are counted as one before that. Only the window over
    the cells moves whole rows; all that comes before reads the order columns and the digest.
    Everything depends on values only, so a task that runs again gives the same numbers.
    """
    names = df.columns
    df = settled(df)
    digest, cell, copies, last = (_free(n, names) for n in ("digest", "cell", "copies", "last"))
    every = [F.col(f"`{c}`") for c in names]
    hashable = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    keyed = df.withColumn(digest, F.xxhash64(*hashable))
    place = [*dict.fromkeys(order_by), digest]
    order = [F.col(f"`{c}`").asc_nulls_first() for c in place]
    # A count is in the footers of a file; more is looked at only if one task can't sort all.
    size = df.count()
    if size <= rows_per_cell:
        return keyed.select(*every, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("bigint").alias(name))

    tree = CutTree.of(keyed, place, size, rows_per_cell)
    hot = _frequent(keyed, digest, rows_per_cell) if len(hashable) == len(names) else None
    rows = keyed.withColumn(copies, F.lit(1).cast("bigint"))
    if hot is not None:
        # Copies of a frequent row are counted before they move.
        many = keyed.join(hot, digest, "left_semi").groupBy(*every, F.col(digest)).agg(F.count(F.lit(1)).alias(copies))
        rows = rows.join(hot, digest, "left_anti").unionByName(many)
    rows = tree.with_cell(rows, cell)
    within = Window.partitionBy(cell).orderBy(*order)
    if hot is None:
        position = F.row_number().over(within).cast("bigint")
    else:
        position = F.sum(copies).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.select(*every, cell, copies, position.alias(last))
    offsets, before = tree.offsets(keyed), _free("before", names)
    placed = placed.join(F.broadcast(offsets.toDF(cell, before)), cell)  # a row for each cell, so at most 65 536
    number = F.col(last) + F.col(before)
    if hot is None:
        return placed.select(*every, number.alias(name))
    # Copies are dealt out in blocks, and then one by one.
    block = _free("block", names)
    blocks = F.sequence(number - F.col(copies) + 1, number, F.lit(COPIES_PER_BLOCK))
    dealt = placed.select(*every, number.alias(last), F.explode(blocks).alias(block))
    end = F.least(F.col(last), F.col(block) + F.lit(COPIES_PER_BLOCK - 1))
    return dealt.select(*every, F.explode(F.sequence(F.col(block), end)).alias(name))


class PageIndex:
    """Pages of a table in a given order, each read by itself.

    The index is the cut tree of `row_numbers` and the rows before each of its cells: a page reads the
    rows of the one or two cells it lies in, not those of the pages before it. Equal rows are in no order
    among each other, as with LIMIT and OFFSET.
    """

    def __init__(self, df: DataFrame, order_by: list[str], rows_per_cell: int = ROWS_PER_CELL):
        self.names = df.columns
        df = settled(df)
        self.digest, self.cell, self.number = (_free(n, self.names) for n in ("digest", "cell", "number"))
        hashable = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        self.rows = df.withColumn(self.digest, F.xxhash64(*hashable))
        self.place = [*dict.fromkeys(order_by), self.digest]
        self.size = df.count()
        self.tree = CutTree.of(self.rows, self.place, self.size, rows_per_cell) if self.size > rows_per_cell else None
        self.offsets = self.tree.offsets(self.rows) if self.tree else None

    def slice(self, first: int, many: int) -> DataFrame:
        """The rows from number ``first`` (from 0) on, at most ``many``, in order."""
        if first < 0 or many < 0:
            raise ValueError("a page begins at 0 at least and has no negative size")
        rows, before = self.rows.withColumn(self.cell, F.lit(0)), {0: 0}
        if self.tree:
            following = F.coalesce(F.lead("before").over(Window.partitionBy(F.lit(0)).orderBy("_cell")), F.lit(self.size))
            met = self.offsets.withColumn("end", following).where((F.col("before") < first + many) & (F.col("end") > first))
            before = {r["_cell"]: r["before"] for r in met.collect()}  # the cells of one page
            rows = self.tree.with_cell(self.rows, self.cell)
            rows = rows.where(F.col(self.cell).between(min(before), max(before)) if before else F.lit(False))
        order = Window.partitionBy(self.cell).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in self.place])
        earlier = F.coalesce(*[F.when(F.col(self.cell) == c, F.lit(n)) for c, n in before.items()], F.lit(0))
        numbered = rows.withColumn(self.number, F.row_number().over(order) - 1 + earlier)
        found = numbered.where((F.col(self.number) >= first) & (F.col(self.number) < first + many)).orderBy(self.number)
        return found.select(*[F.col(f"`{c}`") for c in self.names])

    def page(self, number: int, page_rows: int) -> DataFrame:
        """Page ``number`` (from 0) of ``page_rows`` rows each; behind the last page there are none."""
        return self.slice(number * page_rows, page_rows)


def _frequent(keyed: DataFrame, digest: str, rows_per_cell: int) -> DataFrame | None:
    """Digests of rows whose copies would fill a good part of a cell; none if there are no such rows."""
    counts = keyed.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1, rows_per_cell // 4))
    found = written(counts.select(digest), "frequent")
    return None if found.isEmpty() else found


def _free(name: str, taken: list[str]) -> str:
    """A column name that clashes with none."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def chunk_ids(df: DataFrame, order_by: list[str], n: int, name: str = "chunk") -> DataFrame:
    """Cut rows in chunks of `n` by a given order, numbered from 0."""
    if n < 1:
        raise ValueError("chunk size must be positive")
    number = _free("row_number", df.columns)
    numbered = row_numbers(df, order_by, number)
    return numbered.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.floor((F.col(number) - 1) / F.lit(n)).cast("bigint").alias(name),
    )
