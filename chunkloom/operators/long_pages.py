"""Packing pages that are longer than one task should hold, from a table of their sentences.

``chunks.packed`` keeps a page in one row.  Here a page is as many rows as it has sentences, gathered into stretches of a fixed number, so a page of any
length is packed by many tasks.  A chunk begins where the one before is full, which looks like one chain through the whole page; but the
place after a sentence's chunk is at most a chunk's tokens away, so

1. each stretch, with as many sentences of the next as a chunk can hold, finds by bisection in its prefix sums where a chunk that begins at
   a sentence ends, and so for each of its first sentences where a chain that enters there leaves it, and how many chunks it has begun;
2. these jumps are combined for runs of neighbouring stretches, the runs' jumps for runs of runs, and so on until one is left; from the page's first
   sentence, with which its first chunk begins, the way back gives every stretch its entry and the number of chunks before it;
3. each stretch walks from its entry.  Only the chunks that lie across the edge of a stretch meet again.

No step holds more of a page than a stretch and one chunk, or a run of jumps.  Pages of a single stretch, as most are, take the last step alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..functions.text import let
from ..staging import Staged

#: Sentences in a stretch.
STRETCH = 1 << 14
#: Numbers of jumps that are combined by one task at a time.
RUN = 1 << 20
JUMPS = StructType([StructField("next", ArrayType(IntegerType())), StructField("begun", ArrayType(LongType()))])
ENTRIES = ArrayType(StructType([StructField("entry", IntegerType()), StructField("before", LongType())]))


class Places:
    """Stretches of a batch in one row of places: the sentences of each, those of the next that its chunks can reach, and a place that stands for the page's end."""

    def __init__(self, n: pa.ListArray, cap: pa.ListArray, own: pa.Array):
        sizes, room = n.flatten().to_numpy(zero_copy_only=False), cap.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(n.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        #: The place after a stretch's own sentences, and that of its page's end.
        self.edges, self.ends = self.starts + own.to_numpy(zero_copy_only=False), ends - 1
        self.sums = np.concatenate([[0], np.cumsum(sizes)])
        here = np.arange(len(sizes))
        last = np.repeat(self.ends, ends - self.starts)
        after = np.searchsorted(self.sums, self.sums[:-1] + room, side="right") - 1
        #: The place after the chunk that begins at a place: as many as its room holds, one at least.
        self.after = np.minimum(np.maximum(after, here + 1), last)
        self.inside = here < np.repeat(self.edges, ends - self.starts)


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


@F.arrow_udf(JUMPS)
def _jumps(n: pa.Array, cap: pa.Array, own: pa.Array, entries: pa.Array) -> pa.Array:
    """Where the chains that enter a stretch at its first sentences enter the next one (-1: not, the page ends), and how many chunks they begin before."""
    p = Places(n, cap, own)
    here = np.arange(len(p.after))
    goes, begun = np.where(p.inside, p.after, here), p.inside.astype(np.int64)
    while not np.array_equal(further := goes[goes], goes):
        # what lies ahead of a place doubles
        begun, goes = begun + begun[goes], further
    lengths = np.minimum(entries.to_numpy(zero_copy_only=False), p.edges - p.starts)
    at = np.repeat(p.starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    left, edge, end = goes[at], np.repeat(p.edges, lengths), np.repeat(p.ends, lengths)
    into = np.where(left == end, -1, left - edge).astype(np.int32)
    return pa.StructArray.from_arrays([_lists(lengths, pa.array(into)), _lists(lengths, pa.array(begun[at]))], names=["next", "begun"])


@F.arrow_udf(ArrayType(IntegerType()))
def _walk(n: pa.Array, cap: pa.Array, own: pa.Array, entry: pa.Array) -> pa.Array:
    """Which of a stretch's sentences begin a chunk, from its entry on (-1: none)."""
    p = Places(n, cap, own)
    first = entry.to_numpy(zero_copy_only=False)
    begins = np.zeros(len(p.after) + 1, dtype=bool)
    at = (p.starts + first)[first >= 0]
    # all stretches of the batch go one chunk on at a time
    while len(at := at[p.inside[at]]):
        begins[at] = True
        at = p.after[at]
    found = np.flatnonzero(begins)
    upto = np.searchsorted(found, p.ends, side="right")
    lengths = np.diff(np.concatenate([[0], upto]))
    return _lists(lengths, pa.array((found - np.repeat(p.starts, lengths)).astype(np.int32)))


@F.arrow_udf(JUMPS)
def _combined(runs: pa.Array) -> pa.Array:
    """The jumps of stretches in a row (next, begun) as one jump."""
    found, counts = [], []
    for run in runs:
        # a row's own values: as many small arrays as it has stretches
        inner = run.values
        nexts, begun = inner.field("next"), inner.field("begun")
        at, n = nexts[0].values.to_numpy(zero_copy_only=False), begun[0].values.to_numpy(zero_copy_only=False)
        for i in range(1, len(inner)):
            goes, more = nexts[i].values.to_numpy(zero_copy_only=False), begun[i].values.to_numpy(zero_copy_only=False)
            there = at >= 0
            n = n + np.where(there, more[np.where(there, at, 0)], 0)
            at = np.where(there, goes[np.where(there, at, 0)], -1)
        found.append(at)
        counts.append(n)
    lengths = np.array([len(x) for x in found])
    empty = [np.zeros(0, dtype=np.int64)]
    return pa.StructArray.from_arrays([_lists(lengths, pa.array(np.concatenate(found + empty).astype(np.int32))), _lists(lengths, pa.array(np.concatenate(counts + empty)))], names=["next", "begun"])


@F.arrow_udf(ENTRIES)
def _entries(runs: pa.Array, entry: pa.Array, before: pa.Array) -> pa.Array:
    """The entry of each of the stretches in a row, and the chunks before it, from those of the first."""
    lengths, at, counts = [], [], []
    for run, e, b in zip(runs, entry.to_pylist(), before.to_pylist(), strict=True):
        inner = run.values
        lengths.append(len(inner))
        nexts, begun = inner.field("next"), inner.field("begun")
        for i in range(len(inner)):
            at.append(e)
            counts.append(b)
            if e >= 0:
                e, b = nexts[i].values[e].as_py(), b + begun[i].values[e].as_py()
    return _lists(np.array(lengths), pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(counts, pa.int64())], names=["entry", "before"]))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _gathered(units: DataFrame, stretch: int, staged: Staged) -> DataFrame:
    """``units`` as written rows of stretches: (page_id, stretch, n, cap, tokens, and t if there are texts); tokens are as given, sizes and rooms one at least."""
    texts = [F.col("t")] if "t" in units.columns else []
    given = units.select("page_id", F.floor(F.col("k") / stretch).cast("long").alias("stretch"), F.struct(F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"), F.col("cap").cast("long").alias("cap"), *texts).alias("u"))
    rows = given.groupBy("page_id", "stretch").agg(F.sort_array(F.collect_list("u")).alias("u"))
    of = lambda f: F.transform("u", f)
    one = lambda c: F.greatest(c, F.lit(1))
    more = [of(lambda u: u["t"]).alias("t")] if texts else []
    return staged.write(rows.select("page_id", "stretch", of(lambda u: one(u["n"])).alias("n"), of(lambda u: one(u["cap"])).alias("cap"), of(lambda u: u["n"]).alias("tokens"), *more), "stretches")


def _placed(rows: DataFrame, stretch: int, staged: Staged) -> DataFrame:
    """``rows`` of stretches with ``starts``, the sentences that begin a chunk, ``entry``, the first of them or -1, ``before``, the chunks of earlier stretches,
    and ``more``, whether the page goes on."""
    most = rows.agg(F.coalesce(F.max(F.array_max("cap")), F.lit(1))).first()[0]
    halo = int(most) + 1  # sentences have a token at least, so no chunk has more than ``cap``
    if halo > stretch:
        raise ValueError(f"a stretch of {stretch} sentences cannot hold a chunk of {most} tokens")
    # to the place of the page's end nothing is added
    closed = lambda c, more: F.concat(c, more, F.array(F.lit(1).cast("long")))
    none = F.expr("cast(array() as array<bigint>)")
    short = (F.col("stretch") == 0) & (F.size("n") < stretch)
    walk = lambda df: df.withColumn("starts", _walk("nn", "cc", F.size("n"), "entry")).drop("nn", "cc")
    single = rows.where(short).withColumns({"nn": closed(F.col("n"), none), "cc": closed(F.col("cap"), none), "entry": F.lit(0), "before": F.lit(0).cast("long"), "more": F.lit(False)})
    long = rows.where(~short)
    if long.isEmpty():
        return walk(single)
    heads = long.where("stretch > 0").select(F.col("page_id").alias("p"), (F.col("stretch") - 1).alias("s"), F.slice("n", 1, halo).alias("hn"), F.slice("cap", 1, halo).alias("hc"))

    def reaching(df: DataFrame) -> DataFrame:
        """With the next stretch's first sentences."""
        met = df.join(heads, _same("page_id", "p") & (F.col("stretch") == F.col("s")), "left")
        return met.withColumns({"nn": closed(F.col("n"), F.coalesce("hn", none)), "cc": closed(F.col("cap"), F.coalesce("hc", none)), "more": F.col("hn").isNotNull()}).drop("p", "s", "hn", "hc")

    level = staged.write(reaching(long.select("page_id", "stretch", "n", "cap")).select("page_id", F.col("stretch").alias("at"), _jumps("nn", "cc", F.size("n"), F.lit(halo)).alias("j")), "jumps")
    width, levels = max(2, RUN // halo), []
    while True:
        runs = level.groupBy("page_id", F.floor(F.col("at") / width).cast("long").alias("at")).agg(F.sort_array(F.collect_list(F.struct("at", "j.next", "j.begun"))).alias("run"))
        levels.append(staged.write(runs, "runs"))
        if levels[-1].where("at > 0").isEmpty():
            break
        level = staged.write(levels[-1].select("page_id", "at", _combined("run").alias("j")), "jumps")
    known = levels[-1].select("page_id", "run", F.lit(0).alias("entry"), F.lit(0).cast("long").alias("before"))
    for below in [*levels[-2::-1], None]:
        opened = known.select("page_id", F.explode(F.arrays_zip(F.transform("run", lambda r: r["at"]).alias("at"), _entries("run", "entry", "before").alias("e"))).alias("x")).select("page_id", "x.at", "x.e.entry", "x.e.before")
        known = staged.write(opened, "entries")
        if below is not None:
            above = known.select(F.col("page_id").alias("p"), F.col("at").alias("a"), "entry", "before")
            known = below.join(above, _same("page_id", "p") & (F.col("at") == F.col("a"))).select("page_id", "run", "entry", "before")
    entries = known.select(F.col("page_id").alias("p2"), F.col("at").alias("s2"), "entry", "before")
    met = reaching(long).join(entries, _same("page_id", "p2") & (F.col("stretch") == F.col("s2"))).drop("p2", "s2")
    return walk(single).unionByName(walk(met))


def chunk_starts(units: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``units`` (page_id, k, n, cap) -> (page_id, k, chunk_no): the sentences that begin a chunk, and the chunk's number, both from 0.

    ``k`` numbers a page's sentences from 0 without gaps, ``n`` is a sentence's tokens (one at least) and ``cap`` what a chunk that begins with
    it can hold (one at least).  A sentence larger than that has its chunk alone.  Rows may come in any order and from any number of pages; null pages are
    one page.  An empty table gives an empty result.
    """
    staged = Staged(units.sparkSession)
    placed = _placed(_gathered(units.select("page_id", "k", "n", "cap"), stretch, staged), stretch, staged)
    return placed.select("page_id", "stretch", "before", F.posexplode("starts").alias("i", "at")).select("page_id", (F.col("stretch") * stretch + F.col("at")).alias("k"), (F.col("before") + F.col("i")).alias("chunk_no"))


def chunk_texts(units: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``units`` (page_id, k, n, cap, t) -> (page_id, chunk_no, n_sentences, n_tokens, normalized_text): the chunks of pages of any length.

    The sentences before a stretch's first start belong to the last chunk of the stretch before.
    """
    staged = Staged(units.sparkSession)
    placed = _placed(_gathered(units.select("page_id", "k", "n", "cap", "t"), stretch, staged), stretch, staged)
    carried = F.when(F.col("entry") != 0, F.array(F.lit(0))).otherwise(F.expr("cast(array() as array<int>)"))

    def pieces(cuts: Column) -> Column:
        """What a stretch has of each chunk: its number, sentences, tokens and text, and whether another stretch has more of it."""

        def piece(at: Column, i: Column) -> Column:
            size = F.coalesce(F.get(cuts, i + 1), F.size("n")) - at
            n = F.aggregate(F.slice("tokens", at + 1, size), F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
            across = ((i == 0) & (F.col("entry") != 0)) | ((i == F.size(cuts) - 1) & F.col("more"))
            number = F.col("before") + i - F.when(F.col("entry") != 0, 1).otherwise(0)
            return F.struct(number.alias("chunk_no"), size.cast("long").alias("n_sentences"), n.alias("n_tokens"), F.array_join(F.slice("t", at + 1, size), " ").alias("normalized_text"), across.alias("across"))

        return F.transform(cuts, piece)

    opened = placed.withColumn("cuts", F.concat(carried, "starts")).select("page_id", "stretch", F.explode(let(F.col("cuts"), pieces)).alias("c")).select("page_id", "stretch", "c.*")
    columns = ["page_id", "chunk_no", "n_sentences", "n_tokens", "normalized_text"]
    parts = F.sort_array(F.collect_list(F.struct("stretch", "normalized_text")))
    joined = opened.where("across").groupBy("page_id", "chunk_no").agg(F.sum("n_sentences").alias("n_sentences"), F.sum("n_tokens").alias("n_tokens"), F.array_join(F.transform(parts, lambda x: x["normalized_text"]), " ").alias("normalized_text"))
    return opened.where("not across").select(*columns).unionByName(joined.select(*columns))
