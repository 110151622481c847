"""Blocks of a page: numbers, offsets and headings.

A page is one row and its pieces an array, so all of this is row-local: no shuffle.  Tables of blocks
that come from elsewhere take the window forms at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import block_id, built_once, let


#: Numbers that ``prefix_sums`` adds up in one fold; three layers of such runs hold 16 million.
RUN = 256


def prefix_sums(values: Column, layers: int = 3) -> Column:
    """The sum of all earlier values, as longs, for each of an array of numbers.

    A fold that grows an array copies it at every step, so the numbers are folded in runs of RUN, and the runs' sums in the same
    way: work and copies grow in proportion to the array.
    """
    if layers == 1:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.expr("cast(array() as array<bigint>)").alias("out"))
        return F.aggregate(values, start, lambda acc, n: F.struct((acc["sum"] + n).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")), lambda acc: acc["out"])

    def over(v: Column) -> Column:
        # most arrays are one run
        return F.when(F.size(v) <= RUN, prefix_sums(v, 1)).otherwise(in_runs(v))

    def in_runs(v: Column) -> Column:
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.size(v) - 1, F.lit(RUN))).otherwise(F.expr("cast(array() as array<int>)"))
        runs = F.transform(starts, lambda s: prefix_sums(F.slice(v, s + 1, RUN), 1))
        totals = F.transform(starts, lambda s: F.aggregate(F.slice(v, s + 1, RUN), F.lit(0).cast("long"), lambda acc, n: acc + n))
        return let(prefix_sums(totals, layers - 1), lambda before: F.flatten(F.transform(runs, lambda run, k: F.transform(run, lambda x: x + F.get(before, k)))))

    return let(values, over)


def heading_level(block_type: Column) -> Column:
    """1 to 6 for a heading, else null."""
    return F.when(block_type.rlike("^h[1-6]$"), F.substring(block_type, 2, 1).cast("int"))


def headings(pieces: Column) -> Column:
    """The headings among ``pieces``, each with its place, and with its hierarchy: its own text, then that of the
    nearest earlier heading of a lower level, and so on."""
    marked = F.filter(
        F.transform(pieces, lambda p, i: F.struct(i.alias("at"), heading_level(p["block_type"]).alias("level"), p["text"].alias("text"), p["html_id"].alias("html_id"))),
        lambda h: h["level"].isNotNull(),
    )

    # one fold over the headings: the last one of each level that no later one of a lower level has closed, nearest first
    def step(acc: Column, h: Column) -> Column:
        open_ = F.concat(F.array(h), F.filter(acc["open"], lambda x: x["level"] < h["level"]))
        texts = F.transform(open_, lambda x: x["text"])
        return F.struct(open_.alias("open"), F.concat(acc["out"], F.array(texts)).alias("out"))

    def run(heads: Column, before: Column) -> Column:
        """The open headings after each of a run, which ``before`` are open at its start."""
        start = F.struct(before.alias("open"), F.expr("cast(array() as array<array<string>>)").alias("out"))
        return F.aggregate(heads, start, step)

    def after(heads: Column, before: Column) -> Column:
        return F.aggregate(heads, before, lambda acc, h: F.concat(F.array(h), F.filter(acc, lambda x: x["level"] < h["level"])))

    def hierarchies(heads: Column) -> Column:
        # a fold that grows an array copies it at every step, so it grows in runs, and only what is open is carried from run to run
        starts = F.when(F.size(heads) > 0, F.sequence(F.lit(0), F.size(heads) - 1, F.lit(RUN))).otherwise(F.expr("cast(array() as array<int>)"))
        none = F.slice(heads, 1, F.lit(0))
        opened = F.aggregate(
            starts,
            F.struct(none.alias("open"), F.slice(F.array(none), 1, F.lit(0)).alias("out")),
            lambda acc, s: F.struct(after(F.slice(heads, s + 1, RUN), acc["open"]).alias("open"), F.concat(acc["out"], F.array(acc["open"])).alias("out")),
            lambda acc: acc["out"],
        )
        return let(opened, lambda o: F.flatten(F.transform(starts, lambda s, k: run(F.slice(heads, s + 1, RUN), F.get(o, k))["out"])))

    return let(marked, lambda heads: let(hierarchies(heads), lambda texts: F.transform(heads, lambda h, k: F.struct(h["at"].alias("at"), h["html_id"].alias("html_id"), F.get(texts, k).alias("hierarchy")))))


def headings_before(pieces: Column) -> Column:
    """How many headings stand before each of ``pieces``, as longs."""
    return prefix_sums(F.transform(pieces, lambda p: heading_level(p["block_type"]).isNotNull().cast("long")))


@built_once
def _placed_pieces() -> Column:
    """Each piece with its offset and the place of its parent; not the arrays of the page, which would be copied into each block's row."""
    offsets = prefix_sums(F.transform("pieces", lambda p: (F.length(p["text"]) + 1).cast("long")))
    heads = F.filter(F.transform("pieces", lambda p, i: F.when(heading_level(p["block_type"]).isNotNull(), i)), lambda i: i.isNotNull())

    def placed(offset: Column, before: Column, head: Column) -> Column:
        # the last heading before a block is its parent, whatever its level
        return F.transform("pieces", lambda p, i: F.struct(p.alias("p"), F.get(offset, i).cast("int").alias("offset"), F.get(head, (F.get(before, i) - 1).cast("int")).alias("parent")))

    return let(offsets, lambda offset: let(headings_before(F.col("pieces")), lambda before: let(heads, lambda head: placed(offset, before, head))))


def page_blocks(pages: DataFrame) -> DataFrame:
    """One row per block of ``pages`` (id, pieces): index, id, block_type, text, paths, text_offset, text_length, parent_heading_id, html_id."""
    rows = pages.select(F.col("id").alias("page_id"), F.posexplode(_placed_pieces()).alias("index", "b"))
    return rows.select(
        "page_id",
        "index",
        block_id(F.col("page_id"), F.col("index")).alias("id"),
        "b.p.block_type",
        "b.p.text",
        "b.p.xpath",
        "b.p.css_selector",
        F.col("b.offset").alias("text_offset"),
        F.length("b.p.text").alias("text_length"),
        F.when(F.col("b.parent").isNotNull(), block_id(F.col("page_id"), F.col("b.parent"))).alias("parent_heading_id"),
        "b.p.html_id",
    )


def parent_headings(blocks: DataFrame) -> DataFrame:
    """A table of blocks (page_id, index, block_type, id) with the id of the last heading before each, by window."""
    before = Window.partitionBy("page_id").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    heading = F.when(heading_level(F.col("block_type")).isNotNull(), F.col("id"))
    return blocks.withColumn("parent_heading_id", F.last(heading, ignorenulls=True).over(before))


def heading_hierarchy(blocks: DataFrame) -> DataFrame:
    """A table of blocks (page_id, index, block_type, text) with ``hierarchy``: the texts of the headings that a block stands under,
    nearest first; a heading stands under itself.

    By window, the last heading of each level so far; a level counts if no later heading of a lower one has closed it.
    """
    upto = Window.partitionBy("page_id").orderBy("index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = heading_level(F.col("block_type"))
    last = [F.last(F.when(level == k, F.struct(F.col("index").alias("at"), F.col("text").alias("text"))), ignorenulls=True).over(upto).alias(f"_h{k}") for k in range(1, 7)]
    seen = blocks.select("*", *last)
    # level k is open if it is later than every open level above it, and lower levels than the newest heading's are closed
    newest = F.greatest(*[F.col(f"_h{k}.at") for k in range(1, 7)])
    open_, above = [], F.lit(-1)
    own = F.coalesce(*[F.when(F.col(f"_h{k}.at") == newest, F.lit(k)) for k in range(1, 7)])
    for k in range(1, 7):
        here = F.col(f"_h{k}.at")
        open_.append(F.when((here > above) & (F.lit(k) <= own), F.col(f"_h{k}.text")))
        above = F.greatest(above, here)
    return seen.withColumn("hierarchy", F.array_compact(F.array(*reversed(open_)))).drop(*[f"_h{k}" for k in range(1, 7)])
