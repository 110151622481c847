"""SimHash near-dedup with Golay-code keys.

The perfect binary Golay code maps each 23-bit word to the one codeword within three bits.  A 64-bit
fingerprint is cut into three segments of at most 22 bits, each shortened Golay words.  If two fingerprints differ in four bits or
fewer, some two of the three segments (i, j) differ in two bits or fewer together.  Keys of a pair of segments are the codeword
index of segment i, or of it with one bit flipped, next to segment j as it is; and the index of segment i as it is, next to
segment j with one bit flipped.  Two errors in i meet in the word between, and so do two in j; with one in each, the
one fingerprint flips the bit in i and the other that in j.  Most words have six codewords in reach of a flip, not 22, so
a fingerprint has about 80 keys, of 33 bits or more.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Batches, join_hot, materialize, small_side, texts, whole_row
from .components import components

# Fixed value: the generator polynomial of the [23, 12] Golay code.
GENERATOR = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))
MAX_BITS = 4
SHINGLE_WORDS = 4
SEED = 42
BLOCK = 1 << 15


@lru_cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the upper 12 bits, and the error pattern of each syndrome."""

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    upper = np.array([syndrome(i << 11) for i in range(1 << 12)], np.uint32)
    errors = np.zeros(1 << 11, np.uint32)
    bits = [1 << i for i in range(23)]
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                pattern = bits[a] | bits[b] | bits[c]
                errors[syndrome(pattern)] = pattern
    return upper, errors


def golay_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    upper, errors = golay_tables()
    syndromes = upper[words >> 11] ^ (words & np.uint32(0x7FF))
    return (words ^ errors[syndromes]) >> 11


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned 64-bit fingerprints: (row numbers, keys), each key once a row."""
    words, near = [], []
    for start, width in SEGMENTS:
        word = ((prints >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = np.concatenate([[0], np.uint32(1) << np.arange(width, dtype=np.uint32)]).astype(np.uint32)
        words.append((word[:, None] ^ flips).astype(np.int64))
        near.append(golay_index(word[:, None] ^ flips).astype(np.int64))
    columns = []
    for number, (i, j) in enumerate(PAIRS):
        width = SEGMENTS[j][1]
        columns.append(number << 40 | near[i] << width | words[j][:, :1])
        columns.append(number << 40 | near[i][:, :1] << width | words[j][:, 1:])
    keys = np.sort(np.concatenate(columns, axis=1), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rows, _ = np.nonzero(new)
    return rows, keys[new]


def simhash(data: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text; shingles are hashed in blocks, so memory does not grow with its length."""
    words = (data or b"").lower().split()  # bytes.lower() maps A-Z alone
    if not words:
        return 0
    size = min(shingle_words, len(words))
    last = len(words) - size + 1
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for start in range(0, last, BLOCK):
        part = words[start : min(start + BLOCK, last) + size - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = (ends[: len(part) - size + 1] - [len(w) + 1 for w in part[: len(part) - size + 1]]).tolist()
        stops = (ends[size - 1 :] - 1).tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long)."""

    def rows(batches: Batches):
        for batch in batches:
            prints = np.array([simhash(x, shingle_words) for x in texts(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, fp long")


def _keyed(prints: DataFrame) -> DataFrame:
    def rows(batches: Batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(start, 4096).to_numpy(zero_copy_only=False)
                at, keys = golay_keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[at])], names=["key", "fp"])

    # a fingerprint becomes some 80 rows, so a table of few bytes is dealt to all tasks first
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prints.select("fp").repartition(parts, "fp").mapInArrow(rows, "key long, fp long")


def near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def linked(prints: DataFrame) -> DataFrame:
    """(fp, root) for the distinct fingerprints ``prints`` that link to another: root is one name for each component.

    Each key's fingerprints are first held against one of them, the pivot.  Only keys where members of
    another component than the pivot's remain are joined with themselves, those members against all;
    no pairs are formed among fingerprints already known to hang together, however many share a key.
    """
    keyed = _keyed(prints)
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("fp").alias("h"), F.col("fp").alias("pivot"))).alias("p")).where("n > 1")
    buckets = materialize(buckets.select("key", "n", "p.pivot"), "simhash-buckets")
    n_buckets = buckets.count()
    stars = keyed.join(small_side(buckets.select("key", "pivot"), n_buckets, 24), "key").where((F.col("fp") != F.col("pivot")) & near("fp", "pivot"))
    first = materialize(components(stars.select(F.col("fp").alias("a"), F.col("pivot").alias("b"))), "simhash-first")
    # a key of two is settled by its pivot
    members = keyed.join(small_side(buckets.where("n > 2").select("key", "pivot"), n_buckets, 24), "key")
    own, of_pivot = first.select(F.col("node").alias("fp"), F.col("root").alias("own")), first.select(F.col("node").alias("pivot"), F.col("root").alias("of_pivot"))
    members = members.join(own, "fp", "left").join(of_pivot, "pivot", "left")
    members = materialize(members.select("key", "fp", F.coalesce("own", "fp").alias("root"), F.coalesce("of_pivot", "pivot").alias("pivot_root")), "simhash-members")
    others = members.where("root <> pivot_root").select("key", F.col("fp").alias("fp_b"), F.col("root").alias("root_b"))
    bridges = members.join(others, "key").where((F.col("root") != F.col("root_b")) & near("fp", "fp_b"))
    second = components(bridges.select(F.col("root").alias("a"), F.col("root_b").alias("b")))
    merged = first.unionByName(second.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
    second = second.select(F.col("node").alias("root"), F.col("root").alias("final"))
    return merged.join(second, "root", "left").select(F.col("node").alias("fp"), F.coalesce("final", "root").alias("root"))


def _named(prints: DataFrame) -> DataFrame:
    """fp, root (its component's fingerprint), component_id, n_prints and rows (how many have it) for each distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "simhash-distinct")
    named = materialize(distinct.join(linked(distinct), "fp", "left"), "simhash-named")
    alone = named.where("root is null").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"), F.lit(1).cast("long").alias("n_prints"), "rows")
    several = named.where("root is not null")
    groups = materialize(several.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_prints")), "simhash-groups")
    found = join_hot(several.select("root", "fp", "rows"), groups.withColumn("n", F.col("n_prints")), "root", several.count())
    return materialize(found.select(*alone.columns).unionByName(alone), "simhash-prints-named")


def near_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Texts of fewer words than a shingle hash as one; texts without words, and null ones, have fingerprint
    zero and link as any other.  Repeated rows share a fingerprint.  Null ids never name a
    component unless all its ids are null.  Texts of any length are hashed whole, in blocks.  Other columns of ``docs`` are not
    looked at.  An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, shingle_words), "simhash-prints")
    found = join_hot(prints, _named(prints), "fp", prints.count(), "rows")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_prints")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component of fingerprints one row, with the columns of ``docs``: that with the smallest id (null last), then the smallest hash of the text.

    Rows are chosen one by one, so rows that repeat an id or have none stay or go by their own texts.  Nulls,
    empty and long texts are as in ``near_components``; columns of ``docs`` may have any name.
    """
    packed = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), whole_row(docs).alias("row"))
    packed = packed.select("id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"), "text", "row")

    def rows(batches: Batches):
        for batch in batches:
            yield batch.append_column("fp", pa.array(np.array([simhash(x) for x in texts(batch, "text")], np.uint64).view(np.int64)))

    schema = StructType([*packed.schema.fields, StructField("fp", LongType())])
    held = materialize(packed.mapInArrow(rows, schema).withColumn("at", F.monotonically_increasing_id()), "simhash-rows")
    named = _named(held.select(F.col("id").alias("doc_id"), "fp")).select("fp", "root", "rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "at")
    placed = join_hot(held.select("at", "id", "text_hash", "fp"), named, "fp", held.count(), "rows")
    best = materialize(placed.groupBy("root").agg(F.min(order)["at"].alias("at")), "simhash-best")
    return held.join(small_side(best, best.count(), 16), "at", "left_semi").select("row.*")
