"""Named queries over the provided tables, each with the SQL it is held against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import bins
from ..functions import text as T
from ..operators.blocks import heading_hierarchy, page_blocks, parent_headings
from ..operators.chunks import block_splits, chunk_pages, page_rows, with_units
from ..operators.html import register_parse_blocks
from ..operators.long_pages import chunk_texts as long_chunk_texts
from ..operators.overlap import tokenizer_counts
from ..sinks.core import ALL, Composite, JsonSink, Refused, TableSink, chunk_of, payloads, upsert
from ..sources.tables import conversation_pages, fetch_failures, from_json_pages, html_pages, only_ids, page_info, parsed_pages, spread, table, text_pages
from ..staging import scratch_path
from ..streaming.stream import run_from, run_stats
from . import sql

CONFIG = Config()
#: Small chunks, so that the provided tables exercise every way of cutting.
SMALL = Config(chunk_size=sql.SIZE)
WORD_CAP, PREFIX_CAP = sql.WORD_CAP, sql.PREFIX_CAP
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return text_pages(_texts(spark, folder))


def _pages(spark: SparkSession, folder: str, config: Config = CONFIG) -> DataFrame:
    return parsed_pages(spread(table(spark, folder, "pages")), config)


@query
def page_info_rows(spark, folder):
    info = page_info(html_pages(table(spark, folder, "pages")))
    return info.select("page_id", "page_title", F.col("space.key").alias("space_key"), "page_version", "last_modified")


@query
def html_blocks(spark, folder):
    return page_blocks(_pages(spark, folder))


@query
def lateral_blocks(spark, folder):
    """The same by SQL, with the reader as a table function."""
    register_parse_blocks(spark, CONFIG)
    return spark.sql("SELECT CAST(p.page_id AS STRING) AS page_id, b.* FROM {pages} AS p, LATERAL parse_blocks(p.html) AS b", pages=spread(table(spark, folder, "pages")))


@query
def block_counts(spark, folder):
    return page_blocks(_pages(spark, folder)).groupBy("block_type").agg(F.count("*").alias("n_blocks"), F.sum("text_length").alias("n_chars"))


@query
def excluded_class_blocks(spark, folder):
    return page_blocks(_pages(spark, folder, CONFIG.with_(excluded_classes=("ad",)))).select("page_id", "index", "block_type", "text")


@query
def empty_pages(spark, folder):
    """Every fifth page is left with a menu and a blank paragraph, so it has no block."""
    raw = spread(table(spark, folder, "pages"))
    bare = raw.withColumn("html", F.when(F.col("page_id") % 5 == 0, sql.BARE_PAGE).otherwise(F.col("html")))
    return parsed_pages(bare, CONFIG).where((F.size("pieces") == 0) & F.col("error").isNull()).select(F.col("id").alias("page_id"))


def _answers(spark, folder):
    """Pages as a content API's JSON, every other one with its body in the stored form, every third without a space; every
    eleventh is missing, and others are cut, stand in a gateway's HTML or have no id."""
    body = F.when(F.col("page_id") % 2 == 0, F.struct(F.struct(F.col("html").alias("value")).alias("view"))).otherwise(F.struct(F.struct(F.lit("").alias("value")).alias("view")))
    stored = F.when(F.col("page_id") % 2 == 1, F.struct(F.col("html").alias("value")))
    page = F.struct(
        F.col("page_id").cast("string").alias("id"),
        F.concat(F.lit("Page "), F.col("page_id")).alias("title"),
        F.when(F.col("page_id") % 3 > 0, F.struct(F.lit("K").alias("key"), F.lit("Name").alias("name"))).alias("space"),
        F.when(F.col("page_id") % 4 > 0, F.struct((F.col("page_id") % 7).cast("int").alias("number"), F.lit("2024-01-01").alias("when"))).alias("version"),
        body.withField("storage", stored).alias("body"),
        F.struct(F.concat(F.lit("/pages/"), F.col("page_id")).alias("webui")).alias("_links"),
    )
    sent = F.to_json(page)
    p = F.col("page_id")
    json = F.when(p % 11 == 0, None).when(p % 13 == 0, F.substring(sent, F.lit(1), F.length(sent) - 40)).when(p % 17 == 0, F.col("html")).when(p % 19 == 0, F.to_json(F.struct(F.lit("x").alias("title")))).otherwise(sent)
    return table(spark, folder, "pages").select(p.cast("string").alias("id"), json.alias("json"), F.when(p % 11 == 0, "not found").alias("error"))


@query
def json_page_rows(spark, folder):
    """The answers that are pages, read back."""
    return from_json_pages(_answers(spark, folder), "http://wiki.example.com").select(F.col("id").alias("page_id"), "title", "space_key", "space_name", "version", "last_modified", F.md5("body_html").alias("body_md5"), "url")


@query
def json_fetch_failures(spark, folder):
    """The answers that are none."""
    return fetch_failures(_answers(spark, folder))


@query
def made_page_blocks(spark, folder):
    """A page for each region: headings of three levels, a table and nested lists of its nations."""
    nations = table(spark, folder, "nation").select(F.col("n_regionkey").alias("r_regionkey"), F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("n")).alias("n"))
    held = table(spark, folder, "region").join(F.broadcast(nations.groupBy("r_regionkey").agg(F.sort_array(F.collect_list("n")).alias("n"))), "r_regionkey")  # at most a few dozen nations
    cell = lambda x: F.concat(F.lit("<tr><td>"), x["n"], F.lit("<td>"), x["k"].cast("string"))
    item = lambda x: F.concat(F.lit("<li>"), x["n"], F.lit("<ol><li>key <b>"), x["k"].cast("string"), F.lit("</b></ol>"))
    html = F.concat(
        F.lit("<title>t</title><body><h1 id='top'>"),
        "r_name",
        F.lit("</h1><h3>Table</h3><table><thead><tr><th>Nation<th>Key</thead><tbody>"),
        F.array_join(F.transform("n", cell), ""),
        F.lit("</tbody></table><h2>List</h2><ul>"),
        F.array_join(F.transform("n", item), ""),
        F.lit("</ul>"),
    )
    pages = held.select(F.col("r_regionkey").cast("long").alias("page_id"), F.lit("http://x.com/y").alias("url"), html.alias("html"))
    return heading_hierarchy(page_blocks(parsed_pages(pages, CONFIG))).withColumn("hierarchy", F.array_join("hierarchy", " > ")).drop("id", "css_selector")


@query
def mixed_page_blocks(spark, folder):
    """A page for each nation: text beside blocks in one element, and an element that is left out by its id."""
    html = F.concat(F.lit("<body><div>Intro "), "n_name", F.lit("<p>Para "), F.col("n_nationkey").cast("string"), F.lit("</p>More <b>of</b> "), "n_name", F.lit("</div><p id='ad-"), F.col("n_nationkey").cast("string"), F.lit("'>gone</p><section id='s'><p>kept</p></section>"))
    pages = table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("page_id"), F.lit("http://x.com/y").alias("url"), html.alias("html"))
    return page_blocks(parsed_pages(pages, CONFIG.with_(excluded_ids=("ad",)))).select("page_id", "index", "block_type", "text", "xpath", "text_offset")


@query
def conversation_blocks(spark, folder):
    return page_blocks(conversation_pages(table(spark, folder, "conversations"))).select("page_id", "index", "id", "text", "xpath", "text_offset", "text_length")


@query
def doc_blocks(spark, folder):
    return page_blocks(_documents(spark, folder)).select("page_id", "index", "id", "text", "text_offset", "text_length")


@query
def parsed_block_ids(spark, folder):
    return page_blocks(_documents(spark, folder)).select("id", T.page_of_block(F.col("id")).alias("page_id"))


@query
def token_counts(spark, folder):
    return _texts(spark, folder).select("doc_id", T.count_tokens(F.col("text")).alias("n_tokens"))


@query
def normalized_text(spark, folder):
    return _texts(spark, folder).select("doc_id", F.md5(T.normalize_space(F.col("text")).cast("binary")).alias("text_md5"))


@query
def sentence_rows(spark, folder):
    rows = _texts(spark, folder).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("place", "sentence"))
    return rows.select("doc_id", "place", "sentence", T.count_tokens(F.col("sentence")).alias("n_tokens"))


@query
def word_bins(spark, folder):
    rows = table(spark, folder, "benchmark").select("item_id", F.posexplode(bins.split_words(F.col("text"), F.lit(WORD_CAP))).alias("bin", "words"))
    return rows


@query
def greedy_bins(spark, folder):
    lines = table(spark, folder, "benchmark").select("item_id", F.transform(T.words(F.col("text")), lambda w: F.length(w).cast("long")).alias("sizes"))
    return lines.select("item_id", F.posexplode(bins.greedy_bins(F.col("sizes"), F.lit(40))).alias("place", "bin"))


@query
def split_text_parts(spark, folder):
    return _texts(spark, folder).select("doc_id", F.posexplode(bins.split_text(F.col("text"), F.lit(sql.SIZE))).alias("part", "text"))


@query
def sentence_prefix(spark, folder):
    cut = _texts(spark, folder).select("doc_id", bins.take_prefix(F.col("text"), F.lit(PREFIX_CAP), must_take=False).alias("p"))
    return cut.select("doc_id", F.col("p.prefix").alias("prefix"), F.length("p.rest").alias("rest_length"))


@query
def sentence_prefix_forced(spark, folder):
    """The same with room for a few words, some of which are taken where not even the first sentence fits."""
    cut = _texts(spark, folder).select("doc_id", bins.take_prefix(F.col("text"), F.lit(sql.FORCED_CAP), must_take=True).alias("p"))
    return cut.select("doc_id", F.col("p.prefix").alias("prefix"), F.md5("p.rest").alias("rest_md5"))


@query
def block_split_counts(spark, folder):
    """How many blocks more each document has because some were too long for a chunk."""
    return block_splits(_documents(spark, folder), SMALL).where("splits > 0")


@query
def parent_heading_rows(spark, folder):
    return parent_headings(page_blocks(_pages(spark, folder)).drop("parent_heading_id")).select("page_id", "index", "parent_heading_id")


@query
def hierarchy_rows(spark, folder):
    found = heading_hierarchy(page_blocks(_pages(spark, folder)))
    return found.select("page_id", "index", F.array_join("hierarchy", " > ").alias("hierarchy"))


def _tagged(spark, folder):
    """Pages with the labels of their host as headings, nearest first, on every third page none; and their HTML as text."""
    pages = html_pages(table(spark, folder, "pages"))
    labels = F.when(F.col("id").cast("long") % 3 > 0, F.split("space_key", r"\.")).otherwise(F.expr("cast(array() as array<string>)"))
    return pages.select(F.col("id").alias("page_id"), "title", labels.alias("headings"), F.concat(F.lit("  "), F.coalesce("body_html", F.lit(""))).alias("text"))


@query
def tag_token_rows(spark, folder):
    return _tagged(spark, folder).select("page_id", T.tag_tokens(F.col("title"), F.col("headings")).alias("n_tokens"))


@query
def embedding_rows(spark, folder):
    return _tagged(spark, folder).select("page_id", T.embedding_text(F.col("title"), F.col("headings"), F.col("text")).alias("embedding_text"))


@query
def navigation_rows(spark, folder):
    """Links by the block's own id, by the heading's, and by the text, with empty ids among them."""
    own = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("b"), F.col("doc_id"))).when(F.col("doc_id") % 3 == 1, F.lit(""))
    heading = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("h"), F.col("doc_id")))
    return _texts(spark, folder).select("doc_id", T.navigation_url(F.lit("http://example.com/x"), own, heading, F.col("text")).alias("navigation_url"))


@query
def chunk_texts(spark, folder):
    chunks = chunk_pages(_documents(spark, folder), SMALL)
    return chunks.select("page_id", "chunk_no", "normalized_text", "text_length", "navigation_url", "embedding_text")


@query
def chunk_bounds(spark, folder):
    chunks = chunk_pages(_documents(spark, folder), CONFIG)
    return chunks.select("page_id", "chunk_no", "text_length", T.count_tokens(F.col("normalized_text")).alias("n_tokens"))


@query
def page_chunks(spark, folder):
    chunks = chunk_pages(_pages(spark, folder), SMALL)
    return chunks.drop("highlight_metadata").withColumns({c: F.array_join(c, ",") for c in chunks.columns if c.endswith(("indices", "hierarchy"))})


@query
def chunk_fragments(spark, folder):
    chunks = chunk_pages(_documents(spark, folder), SMALL)
    return chunks.select("chunk_id", F.explode("highlight_metadata.core_fragments").alias("f")).select("chunk_id", "f.block_index", "f.block_id", "f.text_offset", "f.text_length", "f.text")


@query
def chunks_overlapping(spark, folder):
    chunks = chunk_pages(_documents(spark, folder), SMALL.with_(chunk_overlap=16))
    return chunks.select("chunk_id", "page_id", "chunk_no", "normalized_text", "overlap_prev_text", "overlap_next_text")


@query
def chunks_overlapping_wide(spark, folder):
    chunks = chunk_pages(_documents(spark, folder), CONFIG.with_(chunk_overlap=64))
    return chunks.select("chunk_id", "page_id", "chunk_no", "normalized_text", "overlap_prev_text", "overlap_next_text")


@query
def long_page_chunks(spark, folder):
    """Chunks of documents as pages of any length are packed: from a table of sentences, in stretches short enough that most documents have several."""
    # not posexplode, whose filter of empty arrays is moved to the scan and there makes all sentences once more
    units = with_units(page_rows(_documents(spark, folder)), SMALL).select("page_id", F.posexplode_outer("units").alias("k", "u")).where("k is not null")
    return long_chunk_texts(units.select("page_id", "k", "u.n", "u.cap", "u.t"), stretch=128)


@query
def tokenizer_token_counts(spark, folder):
    """Tokens of each document by a tokenizer file."""
    import public_tokenizers

    return tokenizer_counts(_texts(spark, folder).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")).drop("text")


@query
def tokenizer_chunks(spark, folder):
    """Chunks bounded by a tokenizer's tokens."""
    import public_tokenizers

    config = CONFIG.with_(strategy="tokenizer", tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"), chunk_size=256, chunk_overlap=32)
    return chunk_pages(_documents(spark, folder), config).select("chunk_id", "page_id", "chunk_no", "normalized_text", "overlap_prev_text")


@query
def chunk_payloads(spark, folder):
    return payloads(chunk_pages(_documents(spark, folder), CONFIG))


@query
def chunk_payload_fields(spark, folder):
    """What the JSON of each chunk says of some of its fields."""
    found = payloads(chunk_pages(_documents(spark, folder), SMALL))
    field = lambda path: F.get_json_object("payload", path)
    return found.select(
        "chunk_id",
        field("$.page_id").alias("page_id"),
        field("$.page_version").cast("int").alias("page_version"),
        F.md5(field("$.normalized_text")).alias("text_md5"),
        field("$.core_block_ids[0]").alias("first_block"),
        field("$.navigation.text_offset_start").cast("int").alias("text_offset"),
        field("$.navigation.text_length").cast("int").alias("text_length"),
        field("$.nearest_heading_id").alias("nearest_heading_id"),
    )


@query
def chunk_upsert(spark, folder):
    """Labels replace what documents left under their key, ten ids to a key; of several labels the last id counts."""
    key = F.floor(F.col("doc_id") / 10).alias("chunk_id")
    old = table(spark, folder, "documents").groupBy(key).agg(F.concat(F.lit("old "), F.min("source")).alias("payload"))
    new = table(spark, folder, "labels").select(key, F.concat_ws("/", "doc_id", "quality", "toxic").alias("payload"), "doc_id")
    return upsert(old, new, order=["doc_id"])


class _Refusing(JsonSink):
    """Writes JSON, but takes no part that holds a page whose number ends with 50, and says so."""

    def write(self, chunks, pages, blocks, batch=0, part=ALL):
        wrong = lambda page_id: page_id.endswith("50")
        if not pages.where(wrong(F.col("id"))).isEmpty():
            raise Refused("refused", wrong)
        super().write(chunks, pages, blocks, batch, part)


def _ran(spark, folder) -> tuple[DataFrame, Config, list]:
    """A run from an API's answers to JSON and the table, where one sink refuses some pages."""
    config = CONFIG.with_(output_dir=scratch_path(spark, "run"), include_blocks=True, table_enabled=True, base_url="http://wiki.example.com")
    sinks = [_Refusing(config), TableSink(spark, f"{config.output_dir}/table")]
    return run_from(spark, config, spread(_answers(spark, folder)), Composite(sinks)), config, sinks


@query
def run_counters(spark, folder):
    """Counters of a run, chunks aside."""
    about, _, _ = _ran(spark, folder)
    names = ("page_ids", "pages_fetched", "pages_fetch_failed", "pages_processed", "pages_process_failed", "pages_with_errors", "pages_write_failed", "blocks_written")
    return about.select(*[F.col(f"stats.{n}").alias(n) for n in names])


@query
def run_sections(spark, folder):
    """What a run has written of pages and blocks as JSON."""
    _, _, (sink, _) = _ran(spark, folder)
    field = lambda path: F.get_json_object("value", path)
    pages = spark.read.text(f"{sink.path}/pages").select(F.lit("page").alias("section"), field("$.page_id").alias("page_id"), field("$.page_title").alias("text"))
    blocks = spark.read.text(f"{sink.path}/blocks").select(F.lit("block").alias("section"), field("$.page_id").alias("page_id"), field("$.text").alias("text"))
    return pages.unionByName(blocks)


@query
def stored_table(spark, folder):
    """The stored table after two batches: all documents, then every tenth, and one in a hundred, with another text; the pages' stale chunks are gone."""
    docs = table(spark, folder, "documents")
    at = scratch_path(spark, "stored-table")
    sink = TableSink(spark, at, replace_pages=True)
    for batch in (docs, docs.where("doc_id % 10 = 0").withColumn("text", F.when(F.col("doc_id") % 100 == 0, F.lit("")).otherwise(F.concat(F.lit("New. "), F.substring_index("text", "\n", 1))))):
        pages = text_pages(batch)
        sink.write(chunk_pages(pages, CONFIG), pages)
    return sink.read().select("chunk_id", "page_id", F.md5(F.get_json_object("payload", "$.normalized_text")).alias("text_md5"))


@query
def chunk_lookup(spark, folder):
    return chunk_of(table(spark, folder, "documents"), "doc_id", text_pages, "EDU:7:0-5", CONFIG).select("chunk_id", "normalized_text")


@query
def chunk_count(spark, folder):
    return chunk_pages(_documents(spark, folder), SMALL).agg(F.count("*").alias("n_chunks"))


@query
def explicit_ids(spark, folder):
    pages = html_pages(only_ids(table(spark, folder, "pages"), ["3", "5", "3", "8", "none"], "page_id"))
    return pages.select(F.col("id").alias("page_id"), "url")


@query
def run_statistics(spark, folder):
    parsed = _documents(spark, folder)
    return run_stats(parsed, chunk_pages(parsed, SMALL))


ORACLES = {name: sql.ORACLES[name] for name in QUERIES if name in sql.ORACLES}
