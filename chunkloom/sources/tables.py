"""Pages from tables: HTML pages, plain documents and conversations, brought to the columns of ``schema.PAGE``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..config import Config
from ..functions.text import absolute_url, quoted, trim_space
from ..operators.html import with_pieces

#: A list of ids at most this long becomes a filter that the scan can take; longer ones are joined.
ID_FILTER = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to all cores if a scan gives them in fewer parts than there are cores, or in a few parts of one file.

    A file's row group is read by one task, so a table of one row group would be parsed and cut by one task.  Tables of
    many parts, as large ones are, stay as they are, without a shuffle.
    """
    cores, parts = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    return rows.repartition(cores) if parts < cores or parts <= 16 * cores and len(rows.inputFiles()) == 1 else rows


def html_pages(raw: DataFrame) -> DataFrame:
    """``raw`` (page_id, url, html) as pages: the title from the HTML, the host of the url as space."""
    entity = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    for coded, plain in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        entity = F.replace(entity, F.lit(coded), F.lit(plain))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)
    return raw.select(
        F.col("page_id").cast("string").alias("id"),
        trim_space(F.coalesce(entity, F.lit(""))).alias("title"),
        host.alias("space_key"),
        host.alias("space_name"),
        F.lit(1).alias("version"),
        F.lit("").alias("last_modified"),
        F.col("html").alias("body_html"),
        F.coalesce("url", F.lit("")).alias("url"),
    )


def parsed_pages(raw: DataFrame, config: Config) -> DataFrame:
    return with_pieces(html_pages(raw), config)


def _line_pieces(text):
    """Each line with a word as a paragraph."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: trim_space(x) != "")
    null = F.lit(None).cast("string")
    return F.transform(
        lines,
        lambda x, i: F.struct(F.lit("p").alias("block_type"), x.alias("text"), F.concat(F.lit("/p["), (i + 1).cast("string"), F.lit("]")).alias("xpath"), null.alias("css_selector"), null.alias("html_id")),
    )


def text_pages(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) as pages whose lines are the pieces; no title."""
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("").alias("title"),
        F.coalesce("source", F.lit("")).alias("space_key"),
        F.coalesce("source", F.lit("")).alias("space_name"),
        F.lit(1).alias("version"),
        F.lit("").alias("last_modified"),
        F.lit("").alias("url"),
        _line_pieces(F.col("text")).alias("pieces"),
        F.lit(None).cast("string").alias("error"),
    )


def conversation_pages(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as one page per conversation, a piece per turn, the role as its tag's place."""
    null = F.lit(None).cast("string")
    turn = F.struct("turn", F.struct(F.lit("p").alias("block_type"), F.coalesce("text", F.lit("")).alias("text"), F.concat_ws("/", F.lit("/turn"), "role").alias("xpath"), null.alias("css_selector"), null.alias("html_id")).alias("p"))
    grouped = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["p"]).alias("pieces"))
    return grouped.select(
        F.col("conv_id").cast("string").alias("id"),
        *[F.lit("").alias(c) for c in ("title", "space_key", "space_name")],
        F.lit(1).alias("version"),
        F.lit("").alias("last_modified"),
        F.lit("").alias("url"),
        "pieces",
        null.alias("error"),
    )


def as_type(text: str | Column, kind: DataType) -> Column:
    """A text as a value of a column's type, so that a filter compares the column as it is stored and reaches the scan; null if it is none."""
    return (F.lit(text) if isinstance(text, str) else text).try_cast(kind)


def only_ids(pages: DataFrame, ids: Sequence[str] | DataFrame | None, column: str = "id") -> DataFrame:
    """The pages of ``ids`` (a list, or a table with a column ``id``), one for each time an id is named; all for None or an empty list.

    ``column`` may be of any type, and a short list becomes a filter that a scan takes, if ``pages`` is a table as it is read.
    """
    if ids is None:
        return pages
    kind, own = pages.schema[column].dataType, quoted(column)
    if isinstance(ids, DataFrame):
        wanted = ids.select(as_type(F.col("id").cast("string"), kind).alias("_wanted"))
    elif not ids:
        return pages
    else:
        wanted = pages.sparkSession.createDataFrame([(x,) for x in ids], "_wanted string").select(as_type(F.col("_wanted"), kind).alias("_wanted"))
        if len(ids) <= ID_FILTER:
            pages = pages.where(own.isin(*[as_type(x, kind) for x in dict.fromkeys(ids)]))
    return pages.join(wanted, own == F.col("_wanted")).drop("_wanted")


API_PAGE = "struct<id:string,title:string,space:struct<key:string,name:string>,version:struct<number:int,when:string>,body:struct<view:struct<value:string>,storage:struct<value:string>>,_links:struct<webui:string>>"


#: What is said of an answer that is no page: a body that was cut, a gateway's HTML, JSON without an id.
UNREADABLE = "unreadable page"


def _parsed(column: str) -> Column:
    kind = API_PAGE.removesuffix(">") + ",_wrong:string>"
    return F.from_json(quoted(column), kind, {"columnNameOfCorruptRecord": "_wrong"})


def judged(raw: DataFrame, column: str = "json") -> DataFrame:
    """``raw`` (id, json, error) with an error, and without JSON, where the JSON cannot be read or has no id."""
    good = F.col("_p._wrong").isNull() & (F.coalesce("_p.id", F.lit("")) != "")
    bad = quoted(column).isNotNull() & ~F.coalesce(good, F.lit(False))
    seen = raw.withColumn("_p", _parsed(column)).withColumn("_bad", bad).drop("_p")
    return seen.withColumns({column: F.when(~F.col("_bad"), quoted(column)), "error": F.when(F.col("_bad"), UNREADABLE).otherwise(F.col("error"))}).drop("_bad")


def from_json_pages(raw: DataFrame, base_url: str = "", column: str = "json") -> DataFrame:
    """Pages from the JSON of a content API: missing fields get defaults, an empty rendered body falls back to the stored one.

    Rows without JSON, or with JSON that is no page, could not be fetched: they are left out, and ``fetch_failures`` has them.
    """
    p = raw.where(quoted(column).isNotNull()).select(_parsed(column).alias("p")).where(F.col("p._wrong").isNull() & (F.col("p.id") != "")).select("p.*")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return p.select(
        F.col("id"),
        text("title").alias("title"),
        text("space.key").alias("space_key"),
        text("space.name").alias("space_name"),
        F.coalesce("version.number", F.lit(1)).alias("version"),
        text("version.when").alias("last_modified"),
        F.coalesce(F.nullif(F.col("body.view.value"), F.lit("")), F.col("body.storage.value"), F.lit("")).alias("body_html"),
        absolute_url(text("_links.webui"), base_url).alias("url"),
    )


def fetch_failures(raw: DataFrame, column: str = "json") -> DataFrame:
    """(id, error) of the pages that could not be fetched or read."""
    return judged(raw, column).where(quoted(column).isNull()).select("id", "error")


def page_info(pages: DataFrame) -> DataFrame:
    """What is kept of a page beside its chunks."""
    return pages.select(
        F.col("id").alias("page_id"),
        F.col("title").alias("page_title"),
        F.struct(F.col("space_key").alias("key"), F.col("space_name").alias("name")).alias("space"),
        "last_modified",
        F.col("version").alias("page_version"),
    )
