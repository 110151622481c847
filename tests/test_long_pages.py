"""Packing of pages from tables of their sentences, against the fold over one row and a plain loop."""

import random
import time

import pytest
from pyspark.sql import functions as F

from chunkloom.config import Config
from chunkloom.operators.chunks import chunk_pages, page_rows, with_units
from chunkloom.operators.long_pages import chunk_starts, chunk_texts
from chunkloom.sources.tables import text_pages

KIND = "page_id string, k long, n long, cap long"


def plain(sizes):
    """(place, number) of the sentences that begin a chunk."""
    out, used, room = [], 0, -1
    for k, (n, cap) in enumerate(sizes):
        if not out or used + n > room:
            out.append((k, len(out)))
            used, room = 0, cap
        used += n
    return out


@pytest.mark.parametrize("stretch", [32, 50, 1 << 14])
def test_starts_against_a_loop(spark, stretch):
    rng = random.Random(1)
    pages = {str(p): [(rng.choice([1, 1, 2, 3, 9, 40]), rng.choice([1, 7, 12, 30])) for _ in range(n)] for p, n in enumerate([1, 2, 31, 32, 33, 64, 500, 1777])}
    pages[None] = [(5, 12)] * 130
    pages["ones"] = [(1, 31)] * 400
    rows = [(p, k, n, cap) for p, sizes in pages.items() for k, (n, cap) in enumerate(sizes)]
    rng.shuffle(rows)
    got = {}
    for r in chunk_starts(spark.createDataFrame(rows, KIND), stretch).collect():
        got.setdefault(r["page_id"], []).append((r["k"], r["chunk_no"]))
    assert {p: sorted(v) for p, v in got.items()} == {p: plain(v) for p, v in pages.items()}


def test_runs_of_stretches_in_levels(spark, monkeypatch):
    """Pages of up to 55 stretches, whose jumps are combined two at a time."""
    monkeypatch.setattr("chunkloom.operators.long_pages.RUN", 1)
    rng = random.Random(2)
    pages = {p: [(rng.choice([1, 1, 2, 9, 40]), rng.choice([1, 12, 31])) for _ in range(n)] for p, n in (("a", 1777), ("b", 64), ("c", 33), ("d", 7), (None, 300))}
    units = spark.createDataFrame([(p, k, n, cap, f"{p}{k}") for p, sizes in pages.items() for k, (n, cap) in enumerate(sizes)], KIND + ", t string")
    want = []
    for p, sizes in pages.items():
        starts = [k for k, _ in plain(sizes)]
        for no, (a, z) in enumerate(zip(starts, [*starts[1:], len(sizes)], strict=True)):
            want.append((str(p), no, z - a, sum(n for n, _ in sizes[a:z]), " ".join(f"{p}{k}" for k in range(a, z))))
    assert sorted((str(r[0]), *r[1:]) for r in chunk_texts(units, 32).collect()) == sorted(want)


def test_many_stretches_do_not_take_a_call_each(spark):
    """A stretch took a Python group of its own, twice, and its sentences three joins."""
    units = spark.range(400_000).select((F.col("id") / 20).cast("long").cast("string").alias("page_id"), (F.col("id") % 20).alias("k"), F.lit(5).cast("long").alias("n"), F.lit(15).cast("long").alias("cap"), F.lit("x").alias("t"))
    begun = time.monotonic()
    assert chunk_texts(units, 16).agg(F.count("*"), F.sum("n_sentences"), F.max("chunk_no"), F.max("normalized_text")).first() == (140_000, 400_000, 6, "x x x")
    assert time.monotonic() - begun < 40


def test_an_empty_table_and_too_short_stretches(spark):
    none = spark.createDataFrame([], KIND)
    assert chunk_starts(none).count() == 0
    with pytest.raises(ValueError, match="cannot hold"):
        chunk_starts(spark.createDataFrame([("a", 0, 5, 100)], KIND), 64)


def test_texts_are_those_of_pages_in_one_row(spark):
    config = Config(chunk_size=48)
    pages = text_pages(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    units = with_units(page_rows(pages), config).select("page_id", F.posexplode("units").alias("k", "u")).select("page_id", F.col("k").cast("long").alias("k"), "u.n", "u.cap", "u.t")
    want = chunk_pages(pages, config).select("page_id", "chunk_no", "normalized_text").collect()
    got = chunk_texts(units, 64).select("page_id", "chunk_no", "normalized_text").collect()
    # a block that is whole keeps its inner white space in one row; sentences are joined by single spaces here
    flat = lambda rows: sorted((r[0], r[1], " ".join(r[2].split())) for r in rows)
    assert flat(got) == flat(want) and len(got) > 500


def test_a_long_page_is_dealt_to_many_tasks(spark):
    n = 600_000
    units = spark.range(n).select(F.lit("long").alias("page_id"), F.col("id").alias("k"), (1 + F.col("id") % 7).alias("n"), F.lit(64).cast("long").alias("cap"))
    starts = chunk_starts(units, 4096).agg(F.count("*").alias("n"), F.max("k").alias("k"), F.max("chunk_no").alias("c")).first()
    want = plain([(1 + i % 7, 64) for i in range(n)])
    assert (starts["n"], starts["k"], starts["c"]) == (len(want), *want[-1])
