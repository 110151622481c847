"""Fill-in-the-middle against a plain version, on odd rows, and for every grammar."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import fill_middle
from chunkloom.llm.queries import op12_fill_middle

TOKENS = {"letters": r"[A-Za-z]+|[^A-Za-z]", "words": r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+", "lines": r"[^\n]*\n|[^\n]+", "characters": r"[\s\S]"}
LONG = "word, 1 " * 40_000
ODD = ["", None, "a", " ", "\n", "ab", "a b", "a\n", "\n\nab\n", "été 漢字 \U0001f600\U0001f600x", "é", "a\U0001f600b", "has <P> in it", "<S>", "x<M>", "<", "P>", "a<b S>c <P d M> <<", "tab\there\x0bx\r\n", "$\n$", "A1b2", "\x85 x", LONG]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(TOKENS["letters"], text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    x, m, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", text, None, None
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, len(units), form, f"<S>{z}<P>{x}<M>{m}" if form == "spm" else f"<P>{x}<S>{z}<M>{m}", len(x), len(m)


def test_odd_texts_against_a_plain_version(spark):
    rows = [(i if i % 9 else None, t, "x", "y", 1) for i, t in enumerate(ODD * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, `_text` string, output int").repartition(5)
    made = fill_middle.transform(docs)
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted(map(tuple, made.collect()), key=key) == sorted([plain(r[0], r[1]) for r in rows], key=key)
    assert {r["form"] for r in made.collect()} == {"plain", "psm", "spm"}
    back = fill_middle.restore(made).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=key) == sorted([(r[0], r[1] or "") for r in rows], key=key)
    assert fill_middle.transform(docs.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("grammar", sorted(TOKENS))
def test_units_of_every_grammar(spark, grammar):
    rows = spark.createDataFrame([(t or "",) for t in ODD], "text string").select("text", fill_middle.units(F.col("text"), grammar).alias("u")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["u"] == re.findall(TOKENS[grammar], r["text"]), r["text"][:50]


def test_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    n = {r["form"]: r["count"] for r in fill_middle.transform(docs, seed=7, plain_percent=50, spm_percent=50, grammar="words").groupBy("form").count().collect()}
    assert abs(n["plain"] - 2000) < 200 and abs(n["spm"] - 1000) < 150 and abs(n["psm"] - 1000) < 150
    assert {r["form"] for r in fill_middle.transform(docs, plain_percent=0, spm_percent=100).collect()} == {"spm"}


def test_oracle(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    said = con.execute(fill_middle.ORACLE_SQL)
    columns = [d[0] for d in said.description]
    got = op12_fill_middle(spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(said.fetchall()) and len(got) == 200
    assert all(r["output_sha256"] != r["restored_sha256"] or r["form"] == "plain" for r in got)


def test_no_python_worker(spark):
    text = op12_fill_middle(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text and text.count("split(") <= 5
