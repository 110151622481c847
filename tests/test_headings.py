"""Headings of long pages, and pages with columns of any name."""

import time

from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.operators.blocks import headings, heading_hierarchy, page_blocks
from chunkloom.operators.html import with_pieces
from chunkloom.sources.tables import parsed_pages


def pages(spark, levels):
    html = "<body>" + "".join(f"<h{k}>H{i}</h{k}><p>a b c.</p>" for i, k in enumerate(levels))
    return parsed_pages(spark.createDataFrame([(1, "http://x", html)], "page_id long, url string, html string"), Config())


def test_hierarchies_of_many_headings(spark):
    """Across runs too, against the window form and a plain loop."""
    levels = [1 + (i * 7 + i // 5) % 6 for i in range(700)]
    found = pages(spark, levels)
    got = found.select(F.explode(headings(F.col("pieces"))).alias("h")).select("h.*").orderBy("at").collect()
    stack, want = [], []
    for i, k in enumerate(levels):
        stack = [(a, b) for a, b in stack if a < k] + [(k, f"H{i}")]
        want.append([t for _, t in reversed(stack)])
    assert [r["hierarchy"] for r in got] == want
    window = heading_hierarchy(page_blocks(found)).where("block_type like 'h%'").orderBy("index").collect()
    assert [r["hierarchy"] for r in window] == want


def test_headings_take_time_in_proportion(spark):
    took = []
    for n in (8_000, 16_000):
        held = pages(spark, [1 + i % 3 for i in range(n)]).select("pieces").cache()
        held.count()
        begun = time.monotonic()
        assert held.select(F.aggregate(headings(F.col("pieces")), F.lit(0), lambda a, h: a + F.size(h["hierarchy"])).alias("n")).first()["n"] >= n
        took.append(time.monotonic() - begun)
        held.unpersist()
    assert took[1] < 2.5 * took[0] + 0.5, took


def test_columns_of_any_name(spark):
    rows = spark.createDataFrame([("k", "v", "<p>x</p>")], "`a``b` string, html string, `body.html` string")
    out = with_pieces(rows, Config(), html="body.html")
    assert out.columns == ["a`b", "html", "pieces", "error"]
    assert out.first()["html"] == "v" and out.first()["pieces"][0]["text"] == "x"
