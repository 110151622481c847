"""Next-fit bins as Column expressions: in order, a bin is closed when the next unit would overfill it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import count_tokens, let, sentences, words


def bin_starts(units: Column) -> Column:
    """Places (from 0) of the units that open a bin.

    ``units`` is an array of structs with ``n``, a unit's size, and ``cap``, the size of a bin that it opens.  A unit larger than
    its bin has it alone.  The fold only grows its result where a bin opens.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("cap"), F.expr("cast(array() as array<int>)").alias("starts"))

    def step(acc: Column, unit: Column) -> Column:
        opens = (acc["at"] == 0) | ((acc["used"] > 0) & (acc["used"] + unit["n"] > acc["cap"]))
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(opens, unit["n"]).otherwise(acc["used"] + unit["n"]).alias("used"),
            F.when(opens, unit["cap"]).otherwise(acc["cap"]).alias("cap"),
            F.when(opens, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"),
        )

    return F.aggregate(units, start, step, lambda acc: acc["starts"])


def sized(texts: Column, cap: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(count_tokens(t).alias("n"), cap.cast("long").alias("cap")))


def greedy_bins(sizes: Column, cap: Column) -> Column:
    """The bin (from 0) of each of an array of sizes."""
    starts = bin_starts(F.transform(sizes, lambda n: F.struct(n.cast("long").alias("n"), cap.cast("long").alias("cap"))))
    return let(starts, lambda s: F.transform(sizes, lambda n, i: F.size(F.filter(s, lambda x: x <= i)) - 1))


def cut_at(units: Column, starts: Column) -> Column:
    """The runs of ``units`` that begin at ``starts``."""
    return F.transform(starts, lambda s, i: F.slice(units, s + 1, F.coalesce(F.get(starts, i + 1), F.size(units)) - s))


def join_bins(texts: Column, cap: Column) -> Column:
    """``texts`` joined by spaces, as many at a time as ``cap`` tokens hold."""
    return let(texts, lambda t: let(bin_starts(sized(t, cap)), lambda s: F.transform(cut_at(t, s), lambda part: F.array_join(part, " "))))


def split_words(text: Column, cap: Column) -> Column:
    """The text in runs of words of at most ``cap`` tokens; a longer word stands alone."""
    return join_bins(words(text), cap)


def split_units(text: Column, cap: Column) -> Column:
    """Sentences of the text with their tokens; a sentence of more than ``cap`` tokens as its runs of words (``whole`` false)."""
    whole = F.transform(sentences(text), lambda s: F.struct(s.alias("t"), count_tokens(s).alias("n")))
    pieces = F.transform(
        whole,
        lambda s: F.when(s["n"] <= cap, F.array(F.struct(s["t"].alias("t"), s["n"].alias("n"), F.lit(True).alias("whole")))).otherwise(
            F.transform(split_words(s["t"], cap), lambda w: F.struct(w.alias("t"), count_tokens(w).alias("n"), F.lit(False).alias("whole")))
        ),
    )
    return F.flatten(pieces)


def part_starts(units: Column, cap: Column) -> Column:
    """Where ``split_text`` begins a part: next-fit over whole sentences; runs of words are parts of their own."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("used"), F.lit(True).alias("closed"), F.expr("cast(array() as array<int>)").alias("starts"))

    def step(acc: Column, unit: Column) -> Column:
        opens = acc["closed"] | ~unit["whole"] | (acc["used"] + unit["n"] > cap)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(opens, unit["n"]).otherwise(acc["used"] + unit["n"]).alias("used"),
            (~unit["whole"]).alias("closed"),
            F.when(opens, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"),
        )

    return F.aggregate(units, start, step, lambda acc: acc["starts"])


def split_text(text: Column, cap: Column) -> Column:
    """The text in parts of whole sentences of at most ``cap`` tokens; longer sentences in runs of words."""
    return let(
        split_units(text, cap),
        lambda u: let(part_starts(u, cap), lambda s: F.transform(cut_at(u, s), lambda part: F.array_join(F.transform(part, lambda x: x["t"]), " "))),
    )


def take_prefix(text: Column, cap: Column, must_take: bool) -> Column:
    """Struct (prefix, rest): as many whole sentences as ``cap`` holds, joined by spaces.

    If not even the first fits: with ``must_take`` its words as far as they fit, else nothing.
    """

    def cut(parts: Column, n: Column) -> Column:
        return F.struct(F.array_join(F.slice(parts, 1, n), " ").alias("prefix"), F.array_join(F.slice(parts, n + 1, F.greatest(F.size(parts) - n, F.lit(0))), " ").alias("rest"))

    def first_bin(parts: Column) -> Column:
        # how many of the first units one bin holds
        return let(bin_starts(sized(parts, cap)), lambda s: F.coalesce(F.get(s, F.lit(1)), F.size(parts)))

    def taken(parts: Column) -> Column:
        fits = count_tokens(F.coalesce(F.get(parts, F.lit(0)), F.lit(""))) <= cap
        by_words = let(words(text), lambda w: cut(w, first_bin(w))) if must_take else F.struct(F.lit("").alias("prefix"), text.alias("rest"))
        return F.when(fits, cut(parts, first_bin(parts))).otherwise(by_words)

    return let(sentences(text), taken)
