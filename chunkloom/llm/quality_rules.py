"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, whole_row

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is was for with on by that are at it as from this be an or not "
    "le la les de et des un une que est en au dans pour par sur qui du pas "
    "der die das und zu den mit von ist ein eine nicht im auf für dem sich "
    "el los las se con del por su al lo y"
).split()
PUNCTUATION = ".,;:!?\"'()[]"


@dataclass(frozen=True)
class Rule:
    """A document passes if ``least <= metric <= most``; a bound of None is open."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value = F.col(self.metric)
        tests = [value >= self.least] if self.least is not None else []
        tests += [value <= self.most] if self.most is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))


RULES = (
    Rule("enough_words", "n_words", least=50),
    Rule("repeated_words", "repeat_ratio", most=0.5),
    Rule("word_length", "mean_word_chars", least=2, most=15),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.04),
    Rule("capitals", "capital_ratio", most=0.3),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the metrics that rules can name, as columns of the same rows.

    A word is a run of other than ASCII white space.  A null or empty text has no words, no lines and
    ratios of 0.  Texts of any length stay within their row: 3-word windows are sorted inside it, so
    no shuffle happens.  Columns of ``docs`` that bear the name of a metric, or begin with ``__rules_``, give way.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{WS}]"))
    start = docs.withColumns({"__rules_words": F.array_remove(F.split(whole, f"[{WS}]+"), ""), "__rules_lines": lines})
    counted = start.withColumns(
        {
            "n_words": F.size("__rules_words").cast("long"),
            "word_chars": F.aggregate("__rules_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_capitals": F.regexp_count(whole, F.lit("[A-Z]")).cast("long"),
            "n_stop_words": F.size(F.filter("__rules_words", lambda w: F.lower(F.btrim(w, F.lit(PUNCTUATION))).isin(STOP_WORDS))).cast("long"),
            "n_lines": F.size("__rules_lines").cast("long"),
            "n_dup_lines": (F.size("__rules_lines") - F.size(F.array_distinct("__rules_lines"))).cast("long"),
            "__rules_windows": F.when(
                F.size("__rules_words") >= 3,
                F.sort_array(
                    F.transform(
                        F.slice("__rules_words", 1, F.size("__rules_words") - 2),
                        lambda w, i: F.struct(F.concat_ws(" ", w, F.get("__rules_words", i + 1), F.get("__rules_words", i + 2)).alias("w"), i.alias("i")),
                    )
                ),
            ).otherwise(F.expr("cast(array() as array<struct<w:string,i:int>>)")),
        }
    )
    # sorted windows with an equal neighbour occur twice or more; their places, in text order
    same = lambda x, i, step: x["w"].eqNullSafe(F.get("__rules_windows", i + step)["w"])
    places = counted.withColumn("__rules_at", F.array_sort(F.transform(F.filter("__rules_windows", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])))
    # each place covers three words, less those that the place before has covered
    covered = F.transform("__rules_at", lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("__rules_at", i - 1), F.lit(-3))))
    full = places.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x))
    share = lambda part, of: F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(0.0)
    return full.withColumns(
        {
            "mean_word_chars": share("word_chars", "n_words"),
            "symbol_ratio": share("n_symbols", "n_words"),
            "stop_ratio": share("n_stop_words", "n_words"),
            "capital_ratio": share("n_capitals", "word_chars"),
            "dup_line_ratio": share("n_dup_lines", "n_lines"),
            "repeat_ratio": share("n_repeat_words", "n_words"),
        }
    ).drop("__rules_words", "__rules_lines", "__rules_windows", "__rules_at")


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with metrics, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``.

    Every input row gives one output row, repeated rows too.  A null text fails for want of words.  Columns that
    ``docs`` already has by the name of a metric or verdict give way to it.
    """
    measured = measure(docs, text)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules])) if rules else F.expr("cast(array() as array<string>)")
    return measured.withColumns({"base_failed": base_failed, "failed_rules": failed}).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` alone."""
    packed = docs.select(F.col(text).alias("text"), whole_row(docs).alias("_row"))
    judged = judge(packed, rules)
    # a filter on ``kept`` would be pushed below the projections, which copies their expressions into it again and again
    return judged.select(F.explode(F.when(F.col("kept"), F.array("_row"))).alias("_row")).select("_row.*")


def _sql_list(words: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_W = r"[^\x20\x09-\x0D]"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}+') AS w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_W}')) AS l FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a WHERE len(w) >= 3),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM p),
c AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM t WHERE n >= 2) GROUP BY doc_id),
m AS (SELECT a.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
             len(list_filter(w, lambda x: list_contains({_sql_list(STOP_WORDS)}, lower(trim(x, '{PUNCTUATION.replace("'", "''")}'))))) AS n_stop,
             len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM a LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1 AND n_stop / n_words >= 0.04
       AND n_capitals / word_chars <= 0.3 AND n_dup_lines / n_lines <= 0.5 AS kept
FROM b
"""
