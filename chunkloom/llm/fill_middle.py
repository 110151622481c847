"""Fill-in-the-middle: a text is cut at two of its units' boundaries, and the middle is moved to the end.

A grammar says what the units of a text are.  It becomes one regex of zero width that holds between two neighbouring characters of
which a unit ends with the first, told by the classes of the two alone; Spark's ``split`` at it gives the units without a loss.
A split of the empty text gives one empty piece, so that text is set apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, quoted

ANY = r"[\s\S]"
MARKERS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
#: Order of the parts in each form's output.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}


@dataclass(frozen=True)
class Grammar:
    """Regex class bodies, no two of which share a character: characters of one of ``runs`` that stand together are one unit, and so are all others
    if ``rest`` says so, else each is a unit of its own.  With ``lines`` units end with such a character instead."""

    runs: tuple[str, ...] = ()
    rest: bool = False
    lines: str = ""

    def boundary(self) -> str:
        """A regex of zero width for the places between units, neither at the start nor at the end of a text."""
        if self.lines:
            return f"(?<=[{self.lines}])(?={ANY})"
        ends = [f"(?<=[{run}])(?=[^{run}])" for run in self.runs]
        every = "".join(self.runs)
        other = f"[^{every}]" if every else ANY
        return "|".join([*ends, f"(?<={other})(?={f'[{every}]' if self.rest else ANY})"])


GRAMMARS = {
    "letters": Grammar(runs=("A-Za-z",)),
    "words": Grammar(runs=(WS,), rest=True),
    "lines": Grammar(lines=r"\n"),
    "characters": Grammar(),
}


def units(text: Column, grammar: str = "letters") -> Column:
    """The units of ``text`` in order; joined they are the text.  The empty text has none."""
    return F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(text, GRAMMARS[grammar].boundary(), -1))


def draws(doc_id: Column, seed: int) -> Column:
    """Four numbers below 2**32 from the seed and the id's decimal text (null: none)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substring(digest, 8 * i + 1, F.lit(8)), 16, 10).cast("long"))


def _laid_out(order: Sequence[str]) -> Column:
    return F.concat(*[x for part in order for x in (F.lit(MARKERS[part]), F.col(f"_{part}"))])


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, grammar: str = "letters") -> DataFrame:
    """Rows (doc_id, n, form, output, prefix_chars, middle_chars) of ``docs`` (doc_id, text), row by row, without a shuffle.

    n is the number of units, form plain, psm or spm; ``output`` is the text in that form; prefix_chars and middle_chars are null if it is
    plain.  Null texts count as empty, and the empty text and texts that hold a marker stay plain.  Rows that repeat an id draw the same numbers, and null
    ids those of an empty id.  Texts of any length are cut whole.  Other columns of ``docs`` are not looked at, whatever their names.  An empty table
    gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    cut = rows.withColumn("_units", units(F.col("_text"), grammar)).withColumn("_h", draws(F.col("doc_id"), seed))
    h = lambda i: F.col("_h")[i]
    n = F.size("_units").cast("long")
    placed = cut.withColumns({"n": n, "_a": F.least(h(0) % (n + 1), h(1) % (n + 1)).cast("int"), "_b": F.greatest(h(0) % (n + 1), h(1) % (n + 1)).cast("int")})
    held = F.lit(False)
    for marker in MARKERS.values():
        held = held | F.contains("_text", F.lit(marker))
    form = F.when((F.col("_text") == "") | held | (h(2) % 100 >= 100 - plain_percent), "plain").when(h(3) % 100 < spm_percent, "spm").otherwise("psm")
    joined = lambda start, length: F.array_join(F.slice("_units", start, length), "")
    parts = placed.withColumns({"form": form, "_prefix": joined(F.lit(1), F.col("_a")), "_middle": joined(F.col("_a") + 1, F.col("_b") - F.col("_a"))})
    rest = parts.withColumn("_suffix", joined(F.col("_b") + 1, F.size("_units") - F.col("_b")))
    output = F.col("_text")
    for name, order in FORMS.items():
        output = F.when(F.col("form") == name, _laid_out(order)).otherwise(output)
    chars = lambda part: F.when(F.col("form") != "plain", F.length(f"_{part}").cast("long")).alias(f"{part}_chars")
    return rest.select("doc_id", "n", "form", output.alias("output"), chars("prefix"), chars("middle"))


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` (output, form) with ``text``, the text that ``transform`` was given, from these two alone.

    A text that is not plain holds no marker, and no marker can come about where parts meet, so its output has just three.
    """
    parts, output, form = quoted("_parts"), quoted("output"), quoted("form")
    cut = rows.withColumn("_parts", F.split(output, "|".join(MARKERS.values()), -1))  # what stands before the first marker is empty
    text = output
    for name, order in FORMS.items():
        text = F.when(form == name, F.concat(*[F.get(parts, F.lit(order.index(p) + 1)) for p in ("prefix", "middle", "suffix")])).otherwise(text)
    return cut.withColumn("text", text).drop("_parts")


ORACLE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(s, 8 * i + 1, 8))::UBIGINT::BIGINT) AS h FROM t),
p AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS x, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS z FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || m WHEN 'spm' THEN '<S>' || z || '<P>' || x || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""
