import pytest
from pyspark.sql import functions as F

from chunkloom.functions import bins
from chunkloom.functions import text as T


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, n", [("Hello, world!", 4), ("", 0), ("a_1 б2", 2), ("x y", 2), ("…»", 2)])
def test_count_tokens(spark, text, n):
    assert value(spark, T.count_tokens(F.lit(text))) == n


@pytest.mark.parametrize(
    "text, expected",
    [
        ('Hello world. "Bye." (ok?) yes!', ["Hello world.", '"Bye."', "(ok?)", "yes!"]),
        ("a.b c.. d…» e", ["a.b c..", "d…»", "e"]),
        ("  ", []),
        ("", []),
        ("no end", ["no end"]),
        ("a.\n b!", ["a.", "b!"]),
    ],
)
def test_sentences(spark, text, expected):
    assert value(spark, T.sentences(F.lit(text))) == expected


def test_bins(spark):
    assert value(spark, bins.split_words(F.lit("cc dd ee ff."), F.lit(3))) == ["cc dd ee", "ff."]
    assert value(spark, bins.split_text(F.lit("A b. cc dd ee ff."), F.lit(3))) == ["A b.", "cc dd ee", "ff."]
    sizes = F.array(*[F.lit(x) for x in (5, 4, 3, 7, 2, 2, 6, 1)])
    assert value(spark, bins.greedy_bins(sizes, F.lit(10))) == [0, 0, 1, 1, 2, 2, 2, 3]
    assert value(spark, bins.split_text(F.lit(""), F.lit(3))) == []


def test_take_prefix_keeps_all_text(spark):
    text = F.lit("A b. cc dd ee ff.")
    assert tuple(value(spark, bins.take_prefix(text, F.lit(3), must_take=True))) == ("A b.", "cc dd ee ff.")
    assert tuple(value(spark, bins.take_prefix(F.lit("aa bb cc. d."), F.lit(2), must_take=True))) == ("aa bb", "cc. d.")
    assert tuple(value(spark, bins.take_prefix(F.lit("aa bb cc. d."), F.lit(2), must_take=False))) == ("", "aa bb cc. d.")


def test_embedding_text_and_tags(spark):
    hierarchy = F.array(F.lit("C"), F.lit("A"))
    assert value(spark, T.embedding_text(F.lit("T"), hierarchy, F.lit("x"))) == "[PAGE] T\n[SECTION] C > A\n[TEXT] x"
    # [ PAGE ] T, [ SECTION ] C > A, [ TEXT ]
    assert value(spark, T.tag_tokens(F.lit("T"), hierarchy)) == 4 + 6 + 3
    assert value(spark, T.embedding_text(F.lit(""), F.array().cast("array<string>"), F.lit(" x "))) == "x"
    assert value(spark, T.tag_tokens(F.lit(""), F.array().cast("array<string>"))) == 0


def test_navigation_url(spark):
    none = F.lit(None).cast("string")
    assert value(spark, T.navigation_url(F.lit("u"), none, none, F.lit("a b/c"))) == "u#:~:text=a%20b/c"
    assert value(spark, T.navigation_url(F.lit("u"), F.lit("i"), F.lit("h"), F.lit("a"))) == "u#i"
    assert value(spark, T.navigation_url(F.lit("u"), F.lit(""), F.lit("h"), F.lit("a"))) == "u#h"


def test_ids(spark):
    assert value(spark, T.page_of_block(F.lit("EDU:a-b-7"))) == "a-b"
    assert value(spark, T.page_of_block(F.lit("other"))) is None
    assert value(spark, T.chunk_id(F.lit("9"), F.lit(0), F.lit(3))) == "EDU:9:0-3"
    assert value(spark, T.absolute_url(F.lit("/x"), "http://b")) == "http://b/x"
    assert value(spark, T.absolute_url(F.lit("http://c"), "http://b")) == "http://c"


def test_normalize_space(spark):
    assert value(spark, T.normalize_space(F.lit(" a  b \r\n\n\n c\td "))) == "a b c d"


def test_tokens_agree_with_another_engine(spark):
    import regex

    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    made = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "c int, t string")
    rows = made.select("c", T.count_tokens(F.col("t")).alias("n"), F.col("t").rlike(r"\p{Cn}").alias("unknown")).collect()
    # what either engine's Unicode tables do not know yet is left out
    unassigned = regex.compile(r"\p{Cn}")
    known = [r for r in rows if not r["unknown"] and not unassigned.match(chr(r["c"]))]
    assert len(known) > 10_000
    assert not [r["c"] for r in known if r["n"] != len(regex.findall(T.TOKEN, f"a{chr(r['c'])}b"))]
