"""Work on one long document grows in proportion to it."""

import time

from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.operators.blocks import page_blocks, prefix_sums
from chunkloom.operators.chunks import chunk_pages
from chunkloom.operators.html import pieces
from chunkloom.sources.tables import parsed_pages, text_pages


def test_prefix_sums(spark):
    for n in (0, 1, 255, 256, 257, 70_000):
        row = spark.range(1).select(prefix_sums(F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda x: x.cast("long"))).alias("s")).first()["s"]
        assert row == [i * (i + 1) // 2 for i in range(max(n, 1))]
    empty = spark.range(1).select(prefix_sums(F.expr("cast(array() as array<bigint>)")).alias("s")).first()["s"]
    assert empty == []


def test_a_document_of_many_lines(spark):
    n = 200_000
    docs = spark.range(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("Some line of words.\n"), n).alias("text"), F.lit("s").alias("source"))
    begun = time.monotonic()
    last = page_blocks(text_pages(docs)).agg(F.count("*").alias("n"), F.max("text_offset").alias("at")).first()
    assert (last["n"], last["at"]) == (n, (n - 1) * 20) and time.monotonic() - begun < 20
    begun = time.monotonic()
    found = chunk_pages(text_pages(docs), Config(chunk_size=500)).agg(F.count("*").alias("n"), F.sum("text_length").alias("chars")).first()
    assert found["n"] == n / 100 and time.monotonic() - begun < 60


def test_a_page_of_many_headings(spark):
    n = 4000
    html = "<body>" + "".join(f"<h{1 + i % 3}>H{i}</h{1 + i % 3}><p>a b c.</p>" for i in range(n))
    pages = parsed_pages(spark.createDataFrame([(1, "http://x", html)], "page_id long, url string, html string"), Config())
    begun = time.monotonic()
    rows = page_blocks(pages).agg(F.count("*").alias("n"), F.count("parent_heading_id").alias("p")).first()
    assert (rows["n"], rows["p"]) == (2 * n, 2 * n - 1) and time.monotonic() - begun < 20


def test_elements_too_deep_to_open_do_not_close_outer_ones():
    found = pieces("<body>" + "<div>" * 250 + "<p>deep</p>" + "</div>" * 55 + "<p>after</p>", Config())
    deep, after = found
    assert deep["text"] == "deep" and after["text"] == "after"
    assert after["xpath"].count("div[") == 195
