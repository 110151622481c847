"""Near copies for the pipeline: Golay keys of SimHash fingerprints and MinHash bands find candidates, and the sets of shingles decide.

Two texts are near copies if the Jaccard similarity of their sets of 5-word shingles is 0.8 or more.  The fingerprint of a set
has the keys of ``simhash``: any two within four bits share one.  Near copies can be up to 12 of 64 bits apart, and Golay keys of that radius
would meet everywhere, so a text has ``BANDS`` further keys of ``BAND_ROWS`` minima each; two texts of similarity s share none of these with probability
(1 - s**BAND_ROWS)**BANDS, 5e-6 at 0.8 and less above.  Every pair that shares a key of either kind is decided exactly.

Most pairs are decided without their sets.  If c of a text's n shingles occur in any other candidate, it shares c shingles at
most with each; so texts x and y can only have a similarity of 0.8 if 9 * min(c_x, c_y) >= 4 * (n_x + n_y).  Copies that are
edited too much fall out by that, each for itself, and the copy with the fewest shingles of its own is the one that the others
are held against first (the pivot), since edited copies are closer to it than to each other.  Texts that are still apart share i_x and i_y
shingles with a pivot; if x and y have no shingle in common that the pivot lacks, they share min(i_x, i_y) at most.  So
a pair is looked at only if it shares such a shingle, or if that bound alone allows it.  That is asked once for a text and a pivot, in however
many keys they meet.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import Batches, materialize, small_side, texts, whole_row
from .components import components
from .simhash import golay_keys, near

SHINGLE_WORDS = 5
#: A similarity of at least 4/5, in whole numbers so that it is met exactly.
PART, WHOLE = 4, 5
BANDS, BAND_ROWS = 40, 6
#: Passes in which each key's texts are held against one of them, before the pairs of those still apart are looked for.
STAR_PASSES = 2
#: Shingles whose minima are taken at a time.
BLOCK = 1 << 8
SEED = 42
#: Golay keys are numbers below this; next to no MinHash key is.
GOLAY_KEYS = 1 << 42


def shingles(data: bytes | None) -> np.ndarray:
    """The set of hashed shingles of a text, ascending; a text of fewer words than a shingle is one, of none has none."""
    words = (data or b"").lower().split()  # bytes.lower() maps A-Z alone
    if not words:
        return np.zeros(0, np.uint64)
    size = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    known = {w: digest(w, SEED) for w in set(words)}
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = (h ^ own[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
    return np.unique(h)


@lru_cache
def _salts() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = BANDS * BAND_ROWS
    return rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1) | np.uint64(1)


def bands(own: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles, one for each band; none of an empty set."""
    if not len(own):
        return np.zeros(0, np.int64)
    salts, factors = _salts()
    least = np.full(len(salts), (1 << 64) - 1, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(own), BLOCK):
            h = (own[start : start + BLOCK, None] ^ salts) * factors
            h ^= h >> np.uint64(32)
            h *= factors
            np.minimum(least, h.min(axis=0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64).view(np.int64)


def fingerprint(own: np.ndarray) -> int:
    """The SimHash fingerprint of a set of shingles; zero for an empty set."""
    ones = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(own), bitorder="little").view(np.uint64)[0])


def tagged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: itself as ``row``, a number ``at`` of its own, id, hash of the text, ``node`` (the hash of its
    set of shingles; texts of one set are one node), the set's size, its fingerprint ``fp`` and its MinHash keys."""
    packed = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), whole_row(docs).alias("row"))
    packed = packed.select("id", F.xxhash64("text").alias("text_hash"), "text", "row")

    def rows(batches: Batches):
        for batch in batches:
            nodes, sizes, prints, keys = [], [], [], []
            for data in texts(batch, "text"):
                own = shingles(data)
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                sizes.append(len(own))
                prints.append(fingerprint(own))
                keys.append(bands(own))
            node, fp = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, prints))
            made = {"node": node, "n": pa.array(sizes, pa.int64()), "fp": fp, "keys": pa.array(keys, pa.list_(pa.int64()))}
            batch = batch.drop_columns(["text"])  # it is in the row
            for name, column in made.items():
                batch = batch.append_column(name, column)
            yield batch

    schema = StructType([*[f for f in packed.schema.fields if f.name != "text"], *[StructField(c, LongType()) for c in ("node", "n", "fp")], StructField("keys", ArrayType(LongType()))])
    return packed.mapInArrow(rows, schema).withColumn("at", F.monotonically_increasing_id())


def _keyed(nodes: DataFrame) -> DataFrame:
    """(key, node): the keys of ``nodes`` (node, n, fp, keys), MinHash and Golay; none of an empty set."""

    def rows(batches: Batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                at, keys = golay_keys(part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part.column("node").to_numpy(zero_copy_only=False)[at])], names=["key", "node"])

    golay = nodes.where("n > 0").select("node", "fp").mapInArrow(rows, "key long, node long")
    return nodes.select(F.explode("keys").alias("key"), "node").unionByName(golay)


def _sets(rows: DataFrame) -> DataFrame:
    """(node, n, own): the sets of shingles of ``rows`` (node, n, row)."""

    def made(batches: Batches):
        for batch in batches:
            own = [shingles(data).view(np.int64) for data in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(own, pa.list_(pa.int64()))], names=["node", "n", "own"])

    return rows.select("node", "n", F.col("row")["text"].cast("string").alias("text")).mapInArrow(made, "node long, n long, own array<long>")


def _common(sets: DataFrame) -> DataFrame:
    """(node, c, alone): how many shingles of each node of ``sets`` another one has too, and those that none has.

    A shingle is counted before it is shuffled, so one that many texts share is a few rows.
    """
    own = sets.select("node", F.explode("own").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("nodes"), F.min("node").alias("node")).where("nodes = 1")
    alone = own.groupBy("node").agg(F.collect_list("shingle").alias("alone"))
    alone = sets.select("node", "n").join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.array().cast("array<long>")))
    return alone.select("node", (F.col("n") - F.size("alone")).alias("c"), "alone")


def _may(c: str, n: str, other_n: str) -> Column:
    """Whether a text of ``n`` shingles, ``c`` of which others have, can be alike to one of ``other_n``."""
    return (PART + WHOLE) * F.col(c) >= PART * (F.col(n) + F.col(other_n))


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) of nodes those that are near copies."""
    pairs = materialize(pairs.distinct(), "near-pairs")
    count = pairs.count()
    # an array goes with each pair once, and only those of nodes that a pair names are shuffled
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    held = sets.join(small_side(named, 2 * count, 16), "node", "left_semi").select("node", "own")
    left, right = held.select(F.col("node").alias("a"), F.col("own").alias("own_a")), held.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    both = pairs.join(right, "b").join(left, "a").withColumn("shared", F.size(F.array_intersect("own_a", "own_b")))
    return both.where(WHOLE * F.col("shared") >= PART * (F.size("own_a") + F.size("own_b") - F.col("shared"))).select("a", "b")


def _last_pairs(members: DataFrame, sets: DataFrame, common: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``members`` (key, node, n, c, root, pivot, pivot_root) of different roots and one pivot that can be near copies.

    Texts that meet in a key have its pivot in common, so they are held against each other by pivot, whatever number of keys has it.
    """
    placed = materialize(members.select("node", "n", "c", "root", "pivot", "pivot_root").distinct(), "near-placed")
    own, of_pivot = sets.select("node", "own"), sets.select(F.col("node").alias("pivot"), F.col("own").alias("own_p"))
    apart = placed.join(of_pivot, "pivot").join(own, "node").withColumn("other", F.array_except("own", "own_p")).drop("own", "own_p")
    apart = apart.withColumn("shared", F.col("n") - F.size("other")).join(common.select("node", "alone"), "node").withColumn("other", F.array_except("other", "alone")).drop("alone")
    # near copies of a text have 4/5 of its shingles at least, so so many of those that the pivot lacks; in one order for all texts (sets ascend),
    # two texts with that many in common meet in what is left without the last of them but one
    spare = F.greatest(F.floor((PART * F.col("n") + WHOLE - 1) / WHOLE) - F.col("shared") - 1, F.lit(0))
    listed = F.greatest(F.size("other") - spare, F.lit(0)).cast("int")
    held = materialize(apart.withColumn("other", F.slice("other", F.lit(1), listed)), "near-held")
    b = ["node", "n", "c", "root", "shared"]
    renamed = [F.col(c).alias(f"{c}_b") for c in b]
    able = _may("c", "n", "n_b") & _may("c_b", "n_b", "n")
    # by what the pivot lacks: of the texts with such a shingle those of the root that most of them have are not compared with each other
    lacking = held.select("pivot", *b[:4], F.explode("other").alias("shingle"))
    of_root = lacking.groupBy("pivot", "shingle", "root").count().groupBy("pivot", "shingle").agg(F.max(F.struct("count", "root"))["root"].alias("main"), F.count("*").alias("roots"))
    lacking = materialize(lacking.join(of_root.where("roots > 1").drop("roots"), ["pivot", "shingle"]), "near-lacking")
    by_shingle = lacking.where("root <> main").join(lacking.select("pivot", "shingle", *renamed[:4]), ["pivot", "shingle"])
    by_shingle = by_shingle.where(((F.col("root_b") == F.col("main")) | (F.col("root") < F.col("root_b"))) & able)
    # by the bound: only texts that are shorter than the pivot can meet it
    by_bound = held.where("root <> pivot_root").join(held.select("pivot", *renamed), "pivot")
    by_bound = by_bound.where((F.col("root") != F.col("root_b")) & ((PART + WHOLE) * F.least("shared", "shared_b") >= PART * (F.col("n") + F.col("n_b"))))
    return by_shingle.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct().unionByName(by_bound.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct())


def roots(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) for the nodes that link to another; ``nodes`` has node, n, fp, keys and the number ``at`` of one of its rows among ``rows``.

    In a pass each key's nodes are held against one of them, the pivot: first that with the least share of shingles of its own, then others
    at random; nodes known to hang together are not compared.  After the last pass ``_last_pairs`` finds what is left to compare.
    """
    keyed = _keyed(nodes)
    crowded = materialize(keyed.groupBy("key").agg(F.count("*").alias("count")).where("count > 1").select("key"), "near-keys")
    members = materialize(keyed.join(small_side(crowded, crowded.count(), 16), "key").join(nodes.select("node", "n", "fp", "at"), "node"), "near-members")
    ends = members.groupBy("key").agg(F.count("*").alias("count"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    # two fingerprints that meet in a Golay key by chance, not by being alike
    members = members.join(ends.where((F.col("count") == 2) & F.col("key").between(0, GOLAY_KEYS) & ~near("low", "high")).select("key"), "key", "left_anti")
    members = materialize(members.drop("fp"), "near-met")
    wanted = materialize(members.select("node", "at").distinct(), "near-wanted")
    n_wanted = wanted.count()
    sets = materialize(_sets(rows.join(small_side(wanted.select("at"), n_wanted, 16), "at", "left_semi")), "near-sets")
    common = materialize(_common(sets), "near-common")
    members = members.join(small_side(common.select("node", "c"), n_wanted, 24), "node")
    least = members.groupBy("key").agg(F.min("n").alias("least"), F.count("*").alias("count"))
    # a text that is too much on its own for the smallest one in the key has no link by that key
    members = members.join(least, "key").where(_may("c", "n", "least")).select("node", "n", "c", "key", F.col("node").alias("root"))
    members = materialize(members, "near-members")
    named = wanted.select("node", F.col("node").alias("root"))
    for number in range(STAR_PASSES + 1):
        # a key all of whose nodes hang together is settled
        first = [((F.col("n") - F.col("c")) / F.col("n")).alias("own")] if number in (0, STAR_PASSES) else []
        pivot = F.min(F.struct(*first, F.xxhash64("root", F.lit(number)).alias("h"), "root", F.xxhash64("node").alias("g"), "node", "n", "c")).alias("p")
        apart = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), pivot).where("low <> high")
        apart = apart.select("key", F.col("p.root").alias("pivot_root"), F.col("p.node").alias("pivot"), F.col("p.n").alias("n_pivot"), F.col("p.c").alias("c_pivot"))
        apart = materialize(apart, "near-apart")
        count = apart.count()
        if not count:
            break
        members = materialize(members.join(small_side(apart, count, 48), "key"), "near-members")
        if number < STAR_PASSES:
            pairs = members.where(F.col("root") != F.col("pivot_root")).where(_may("c", "n", "n_pivot") & _may("c_pivot", "n_pivot", "n")).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        else:
            pairs = _last_pairs(members, sets, common)
        found = materialize(alike(pairs, sets), "near-links")
        old = named.select(F.col("node").alias("a"), F.col("root").alias("b"))
        new = materialize(components(found.unionByName(old)), "near-roots")
        named = materialize(wanted.join(new, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "near-named")
        members = materialize(members.select("node", "n", "c", "key").join(small_side(named, n_wanted, 16), "node"), "near-members")
    return named


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` of ``tagged`` with ``root``, one name for each component of near copies, never null."""
    nodes = materialize(rows.groupBy("node").agg(F.min("n").alias("n"), F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min("at").alias("at")), "near-nodes")
    found = roots(nodes, rows)
    return rows.select("at", "id", "text_hash", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component of near copies one row, with the columns of ``docs``: that with the smallest id (null last), then the smallest hash of the text.

    Rows are chosen one by one, so rows that repeat an id or have none stay or go by their own texts.
    Texts without words are one component.  An empty table gives an empty result.
    """
    rows = materialize(tagged(docs), "near-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", F.coalesce("text_hash", F.lit(0)).alias("text_hash"), "at")
    found = materialize(grouped(rows), "near-grouped")
    chosen = materialize(found.groupBy("root").agg(F.min(order)["at"].alias("best")), "near-chosen")
    lose = materialize(found.select("at").join(chosen, F.col("at") == F.col("best"), "left_anti"), "near-losers")
    return rows.join(small_side(lose, lose.count(), 16), "at", "left_anti").select("row.*")
