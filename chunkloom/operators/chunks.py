"""Packing the blocks of each page into chunks of bounded tokens.

With simple tokens, which never span white space, packing blocks and cutting them between sentences is next-fit over the
page's sentences, where the room of a chunk depends on the headings that its first block stands under.  So one fold
over an array per page finds where chunks begin, and everything else follows from those places.  All of it is row-local.
Chunks that overlap depend on each other's texts; ``overlap`` packs those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.bins import bin_starts, cut_at, part_starts, split_units
from ..functions.text import block_id, built_once, chunk_id, count_tokens, embedding_text, let, navigation_url, sentences, tag_tokens, trim_space
from ..schema import FRAGMENT, PIECES
from .blocks import heading_level, headings, headings_before, prefix_sums

LEAST_ROOM = 10


def rooms(title: Column, heads: Column, config: Config) -> Column:
    """What a chunk can hold under no heading, and under each of ``heads``: structs (at, html_id, hierarchy, cap, block_cap)."""
    none = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("html_id"), F.expr("cast(array() as array<string>)").alias("hierarchy"))

    def room(h: Column) -> Column:
        shown = F.slice(h["hierarchy"], 1, config.max_heading_levels)
        free = F.lit(config.chunk_size) - tag_tokens(title, shown, config.page_tag, config.section_tag)
        return let(
            free,
            lambda n: F.struct(
                h["at"].alias("at"),
                h["html_id"].alias("html_id"),
                h["hierarchy"].alias("hierarchy"),
                F.when(n > 0, n).otherwise(F.lit(max(LEAST_ROOM, config.chunk_size // 4))).cast("long").alias("cap"),
                F.greatest(n, F.lit(LEAST_ROOM)).cast("long").alias("block_cap"),
            ),
        )

    return F.transform(F.concat(F.array(none), heads), room)


def units(pieces: Column, room: Column) -> Column:
    """Sentences of all blocks in order: structs (p, part, t, n, cap, first, last, under, total).

    ``p`` is the piece, ``part`` the block that an oversized piece was cut into; first and last tell a block's ends; ``under`` is the
    place in ``room`` of the heading that the piece stands under, and ``total`` the whole piece's tokens.
    Headings are never cut, nor is any sentence that its block's room can hold.
    """

    def block(run: Column, i: Column, part: Column, cap: Column, under: Column, total: Column) -> Column:
        return F.transform(
            run,
            lambda u, k: F.struct(
                i.alias("p"), part.alias("part"), u["t"].alias("t"), u["n"].alias("n"), cap.alias("cap"), (k == 0).alias("first"), (k == F.size(run) - 1).alias("last"), under.alias("under"), total.alias("total")
            ),
        )

    def whole(text: Column, n: Column, i: Column, heading: Column, r: Column, under: Column) -> Column:
        one = F.array(F.struct(trim_space(text).alias("t"), n.alias("n")))
        cut = F.transform(sentences(text), lambda s: F.struct(s.alias("t"), count_tokens(s).alias("n")))
        return let(F.when(heading, one).otherwise(cut), lambda run: block(run, i, F.lit(0), r["cap"], under, n))

    def parts(text: Column, n: Column, i: Column, r: Column, under: Column) -> Column:
        cap = r["block_cap"]
        return let(split_units(text, cap), lambda u: let(part_starts(u, cap), lambda s: F.flatten(F.transform(cut_at(u, s), lambda run, k: block(run, i, k, r["cap"], under, n)))))

    def of(p: Column, i: Column, before: Column) -> Column:
        heading = heading_level(p["block_type"]).isNotNull()
        # a piece stands under the headings before it, a heading under itself too
        place = (F.get(before, i) + heading.cast("long")).cast("int")
        return let(
            F.struct(F.get(room, place).alias("r"), count_tokens(p["text"]).alias("n"), place.alias("under")),
            lambda x: F.when(heading | (x["n"] <= x["r"]["block_cap"]), whole(p["text"], x["n"], i, heading, x["r"], x["under"])).otherwise(parts(p["text"], x["n"], i, x["r"], x["under"])),
        )

    return let(headings_before(pieces), lambda before: F.flatten(F.transform(pieces, lambda p, i: of(p, i, before))))


def parts_of(run: Column, pieces: Column) -> Column:
    """The blocks, or parts of blocks, that the sentences of one chunk make up: their piece's fields and the text."""
    blocks = F.array_distinct(F.transform(run, lambda u: F.struct(u["p"].alias("p"), u["part"].alias("part"))))

    def text(own: Column, raw: Column) -> Column:
        joined = F.array_join(F.transform(own, lambda u: u["t"]), " ")
        complete = F.get(own, F.lit(0))["first"] & F.element_at(own, -1)["last"]
        n = F.aggregate(own, F.lit(0).cast("long"), lambda acc, u: acc + u["n"])
        # a block that is whole keeps its inner white space; a cut one is joined from its sentences
        return F.when(complete & (F.get(own, F.lit(0))["total"] == n), raw).otherwise(joined)

    def of(b: Column) -> Column:
        own = F.filter(run, lambda u: (u["p"] == b["p"]) & (u["part"] == b["part"]))
        return let(F.struct(own.alias("u"), F.get(pieces, b["p"]).alias("p")), lambda x: F.struct(*[x["p"][c].alias(c) for c in ("block_type", "xpath", "css_selector", "html_id")], text(x["u"], x["p"]["text"]).alias("text")))

    return F.transform(blocks, of)


#: A packed page: its chunks in order, each with the room it had, its parts of blocks, and what it shows of its neighbours
#: (k: which part of the neighbour).
HELD = (
    "array<struct<html_id:string,hierarchy:array<string>,f:array<struct<block_type:string,xpath:string,css_selector:string,html_id:string,text:string>>,"
    "prev:array<struct<k:int,text:string>>,next:array<struct<k:int,text:string>>>>"
)
PAGE_COLUMNS = ("page_id", "title", "url", "space_key", "version", "last_modified")


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages with the columns that chunks need; blank pieces are dropped.

    Pages without pieces stay: they have no chunks, and a filter would be moved to the scan and there cut every text once more.
    """
    filled = lambda c: F.coalesce(c, F.lit("")).alias(c)
    own = F.coalesce(F.filter("pieces", lambda p: trim_space(p["text"]) != ""), F.expr(f"cast(array() as {PIECES})"))
    return pages.select(F.col("id").alias("page_id"), filled("title"), filled("url"), "space_key", "version", "last_modified", own.alias("pieces"))


@built_once
def _room_column(config: Config) -> Column:
    return rooms(F.col("title"), headings(F.col("pieces")), config)


@built_once
def _unit_column() -> Column:
    # where nothing else uses the rooms, Spark would put their expression in place of the column, and so find all rooms anew for each piece
    return let(F.col("room"), lambda room: units(F.col("pieces"), room))


@built_once
def _held_column() -> tuple[Column, Column]:
    """The runs of units that chunks are, and from these what a chunk holds."""

    def chunk(run: Column) -> Column:
        under = F.get(F.col("room"), F.get(run, F.lit(0))["under"])
        none = F.expr("cast(array() as array<struct<k:int,text:string>>)")
        return let(under, lambda r: F.struct(r["html_id"].alias("html_id"), r["hierarchy"].alias("hierarchy"), parts_of(run, F.col("pieces")).alias("f"), none.alias("prev"), none.alias("next")))

    return let(F.col("units"), lambda u: let(bin_starts(u), lambda s: cut_at(u, s))), F.transform("runs", chunk)


def with_units(rows: DataFrame, config: Config) -> DataFrame:
    """``rows`` with ``room`` and ``units``, the sentences of all blocks in order."""
    return rows.withColumn("room", _room_column(config)).withColumn("units", _unit_column())


def packed(rows: DataFrame, config: Config) -> DataFrame:
    """``rows`` with ``held`` in place of ``pieces``."""
    runs, held = _held_column()
    return with_units(rows, config).withColumn("runs", runs).select(*PAGE_COLUMNS, held.alias("held"))


def block_splits(pages: DataFrame, config: Config) -> DataFrame:
    """(page_id, splits): how many blocks more each of ``pages`` has because some are too long for a chunk."""
    split = with_units(page_rows(pages), config)
    splits = F.when(F.size("units") > 0, F.size(F.filter("units", lambda u: u["first"] & (u["part"] > 0))).cast("long"))
    # a condition on a generator's rows stays above it; one on a plain column is moved to the scan, and all that the column is made of is done twice
    return split.select("page_id", F.explode_outer(F.array(splits)).alias("splits")).where("splits is not null")


def chunk_pages(pages: DataFrame, config: Config) -> DataFrame:
    """One row per chunk of ``pages`` (a page's columns and ``pieces``), with the columns of ``schema.CHUNK``.

    Pages without pieces have no chunks.  Nothing is shuffled.
    """
    rows = page_rows(pages)
    if config.chunk_overlap or config.strategy != "simple":
        from .overlap import packed_overlapping

        return unfold(packed_overlapping(rows, config), config)
    return unfold(packed(rows, config), config)


@built_once
def _numbered_columns() -> tuple[Column, Column]:
    """The numbered parts of a page's chunks, and from these the chunks with what they show of their neighbours."""
    lengths = F.transform("held", lambda c: F.aggregate(c["f"], F.lit(0), lambda n, f: n + F.length(f["text"]) + 1))
    sizes = F.transform("held", lambda c: F.size(c["f"]))

    def fragment(c: Column, f: Column, k: Column, first: Column, offset: Column) -> Column:
        before = F.aggregate(F.slice(c["f"], 1, k), F.lit(0), lambda n, x: n + F.length(x["text"]) + 1)
        return F.struct(
            (first + k).alias("block_index"),
            block_id(F.col("page_id"), first + k).alias("block_id"),
            *[f[x].alias(x) for x in ("block_type", "xpath", "css_selector", "html_id")],
            (offset + before).alias("text_offset"),
            F.length(f["text"]).alias("text_length"),
            F.lit(0).alias("fragment_start"),
            F.length(f["text"]).alias("fragment_end"),
            f["text"].alias("text"),
        )

    cores = let(
        prefix_sums(sizes),
        lambda first: let(prefix_sums(lengths), lambda offset: F.transform("held", lambda c, i: F.transform(c["f"], lambda f, k: fragment(c, f, k, F.get(first, i), F.get(offset, i)).cast(FRAGMENT)))),
    )
    shown = lambda of, i: F.transform(of, lambda x: F.get(F.get(F.col("cores"), i), x["k"]).withField("text", x["text"]))
    chunks = F.transform(
        "held",
        lambda c, i: F.struct(c["html_id"].alias("html_id"), c["hierarchy"].alias("hierarchy"), F.get(F.col("cores"), i).alias("core"), shown(c["prev"], i - 1).alias("prev"), shown(c["next"], i + 1).alias("next")),
    )
    return cores, chunks


def unfold(held: DataFrame, config: Config) -> DataFrame:
    """Number the parts of a page's chunks, and give each chunk a row."""
    cores, chunks = _numbered_columns()
    exploded = held.withColumn("cores", cores).select(*PAGE_COLUMNS, F.posexplode(chunks).alias("chunk_no", "c"))
    joined = lambda of: F.array_join(F.transform(of, lambda f: f["text"]), " ")
    opened = exploded.select(*PAGE_COLUMNS, "chunk_no", "c", joined("c.core").alias("text"), joined("c.prev").alias("before"), joined("c.next").alias("after"), F.slice("c.hierarchy", 1, config.max_heading_levels).alias("shown"))
    whole = F.array_join(F.filter(F.array("before", "text", "after"), lambda t: t != ""), " ")
    return finish(opened.withColumn("full_text", whole), config)


def finish(opened: DataFrame, config: Config) -> DataFrame:
    """The columns of ``schema.CHUNK``."""
    return opened.select(*_final_columns(config.page_tag, config.section_tag))


@built_once
def _final_columns(page_tag: bool, section_tag: bool) -> list[Column | str]:
    core = F.col("c.core")
    first = F.get(core, F.lit(0))
    index = lambda of: F.transform(of, lambda f: f["block_index"])
    own = index(core)
    before, after = F.array_except(index("c.prev"), own), F.array_except(index("c.next"), own)
    own_id = chunk_id(F.col("page_id"), first["block_index"], F.element_at(core, -1)["block_index"])
    highlight = F.struct(
        F.substring("text", 1, 100).alias("text_fragment"),
        first["block_type"].alias("block_type"),
        first["text_offset"].alias("text_offset"),
        first["html_id"].alias("first_block_html_id"),
        F.col("c.html_id").alias("nearest_heading_html_id"),
        core.alias("core_fragments"),
        F.col("c.prev").alias("overlap_prev_fragments"),
        own_id.alias("chunk_id_base"),
        F.when(F.size("c.next") > 0, F.col("c.next")).alias("overlap_next_fragments"),
    )
    return [
        own_id.alias("chunk_id"),
        "page_id",
        "space_key",
        F.col("title").alias("page_title"),
        F.col("version").alias("page_version"),
        "last_modified",
        F.array_distinct(F.concat(before, own, after)).alias("block_indices"),
        own.alias("core_block_indices"),
        before.alias("overlap_prev_block_indices"),
        after.alias("overlap_next_block_indices"),
        F.col("c.hierarchy").alias("full_heading_hierarchy"),
        F.col("shown").alias("text_heading_hierarchy"),
        F.col("c.html_id").alias("nearest_heading_id"),
        F.col("text").alias("normalized_text"),
        F.col("before").alias("overlap_prev_text"),
        F.col("after").alias("overlap_next_text"),
        "full_text",
        embedding_text(F.col("title"), F.col("shown"), F.col("full_text"), page_tag, section_tag).alias("embedding_text"),
        first["xpath"].alias("xpath_start"),
        first["css_selector"].alias("css_selector_start"),
        first["text_offset"].alias("text_offset_start"),
        F.length("text").alias("text_length"),
        navigation_url(F.col("url"), first["html_id"], F.col("c.html_id"), F.col("text")).alias("navigation_url"),
        highlight.alias("highlight_metadata"),
        "chunk_no",
    ]
