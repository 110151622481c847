"""Exact dedup by composable polynomial fingerprints, with a chunkwise comparison of equal ones.

The fingerprint of bytes b[0..n) is the sum of (b[i] + 1) * r**(n-1-i) modulo a prime, for several bases r.
Fingerprints of neighbouring chunks combine by ``fp(a + b) = fp(a) * r**len(b) + fp(b)``, so a text
of any length is hashed as independent chunks of a fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, Batches, materialize, small_side, texts, whole_row

PRIME = 2**31 - 1
BASES = (1_103_515_245, 1_812_433_253, 742_938_285)
CHUNK = 1 << 14
#: Code points in a unit of the chunkwise comparison.
COMPARE_CHARS = 1 << 16
#: Rows of a group that one task compares with the group's first text; larger groups are dealt to several.
PART_ROWS = 128
SPACES = b" \t\n\x0b\x0c\r"


@lru_cache
def _powers(base: int, prime: int, n: int = CHUNK) -> np.ndarray:
    """base**(n-1) ... base**0 modulo the prime."""
    out = np.ones(n, np.uint64)
    for i in range(n - 2, -1, -1):
        out[i] = int(out[i + 1]) * base % prime
    return out


def combine(left: int, right: int, right_len: int, base: int, prime: int = PRIME) -> int:
    """The fingerprint of two neighbouring pieces from theirs."""
    return (left * pow(base, right_len, prime) + right) % prime


def fingerprint(data: bytes, bases: Sequence[int] = BASES, prime: int = PRIME, chunk: int = CHUNK) -> tuple[int, ...]:
    """Chunk hashes (of all chunks at once), then their combination from left to right."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    whole, rest = divmod(len(values), chunk)
    out = []
    for base in bases:
        powers, total = _powers(base, prime, chunk), 0
        if whole:
            step = pow(base, chunk, prime)
            for h in (values[: whole * chunk].reshape(whole, chunk) @ powers) % np.uint64(prime):
                total = (total * step + int(h)) % prime
        if rest:
            total = combine(total, int(values[whole * chunk :] @ powers[chunk - rest :]) % prime, rest, base, prime)
        out.append(total)
    return tuple(out)


FP_SCHEMA = "doc_id long, n_chars long, n_bytes long, h1 long, h2 long, h3 long, text_sha256 string"
KEY = ["n_bytes", "h1", "h2", "h3"]


def fingerprints(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """One row per document: code points of the text, and length, fingerprint and SHA-256 of the text without ASCII white space."""

    def rows(batches: Batches):
        for batch in batches:
            chars, sizes, prints, digests = [], [], [], []
            for data in texts(batch, "text"):
                data = data or b""
                chars.append(len(data) - _continuation_bytes(data))
                bare = data.translate(None, SPACES)
                sizes.append(len(bare))
                prints.append(fingerprint(bare, prime=prime))
                digests.append(hashlib.sha256(bare).hexdigest())
            h = np.array(prints, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (chars, sizes, h[:, 0], h[:, 1], h[:, 2])), pa.array(digests, pa.string())],
                names=["doc_id", "n_chars", *KEY, "text_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, FP_SCHEMA)


def _continuation_bytes(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def _chunks(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Number and content of each piece, without white space, of the texts that ``members`` (id, sha, parts, key) names, and its part of the group."""
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bare = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), f"[{WS}]+", "")
    found = held.join(members, held.doc_id.eqNullSafe(members.id)).select("doc_id", "sha", "parts", *KEY, bare.alias("bare"))
    # an id may repeat with another text
    found = found.where(F.sha2("bare", 256) == F.col("sha"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.length("bare") - 1, F.lit(0)), F.lit(COMPARE_CHARS)), lambda i: F.substring(F.col("bare"), i + 1, F.lit(COMPARE_CHARS)))
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    return found.select("doc_id", F.col("sha").alias("text_sha256"), "parts", part.alias("part"), *KEY, F.posexplode(cut).alias("piece_no", "piece"))


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def classes(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """n_bytes, h1, h2, h3, text_sha256 -> round: the round in which members of a fingerprint proved equal to
    their group's first text.  Fingerprints that no other row has are not in it.

    In each round every group compares its members, piece by piece, with one of them; those that
    differ (a collision) go on to the next round as a group of their own.  A group of more than ``PART_ROWS`` rows
    is dealt in parts, each with its own copy of the first text's pieces.
    """
    distinct = prints.groupBy(*KEY, "text_sha256").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("first_id"), F.count("*").alias("copies"))
    groups = prints.groupBy(*KEY).count().where("count > 1").select(*KEY, F.ceil(F.col("count") / PART_ROWS).alias("parts"))
    groups = materialize(groups, "dedup-groups")
    left = materialize(distinct.join(groups.drop("parts"), KEY), "dedup-left")
    done = None
    number = 0
    while True:
        heads = left.groupBy(*KEY).agg(F.min("text_sha256").alias("head_sha"))
        marked = left.join(heads, KEY).withColumn("round", F.lit(number))
        if number == 0:
            # every row of a group of copies takes part, not one row for each digest
            members = prints.join(small_side(groups, groups.count(), 48), KEY).select("doc_id", "text_sha256", "parts", *KEY).distinct()
        else:
            members = members.join(left.select(*KEY, "text_sha256"), [*KEY, "text_sha256"], "left_semi")
        members = materialize(members, "dedup-members")
        n = members.count()
        ids = members.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), "parts", *KEY)
        pieces = materialize(_chunks(docs, small_side(ids, n, 120)), "dedup-pieces")
        firsts = marked.where("text_sha256 = head_sha").select(*KEY, F.col("first_id"), F.col("head_sha"))
        f = small_side(firsts, n, 120)
        head = pieces.join(f, _same(pieces, f, KEY) & pieces.doc_id.eqNullSafe(f.first_id) & (pieces.text_sha256 == f.head_sha))
        head = head.select(*(pieces[k] for k in KEY), pieces.piece_no, pieces.parts, pieces.piece.alias("head_piece")).dropDuplicates([*KEY, "piece_no"])
        head = head.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        compared = pieces.join(materialize(head, "dedup-heads"), [*KEY, "piece_no", "part"], "left")
        verdict = compared.groupBy(*KEY, "text_sha256").agg(F.min(F.col("piece").eqNullSafe(F.col("head_piece"))).alias("equal"))
        verdict = materialize(verdict, "dedup-verdict")
        equal = verdict.where("equal").select(*KEY, "text_sha256", F.lit(number).alias("round"))
        done = equal if done is None else done.unionByName(equal)
        differing = verdict.where("not equal").count()
        if not differing:
            return done
        left = materialize(left.join(verdict.where("not equal").select(*KEY, "text_sha256"), [*KEY, "text_sha256"], "left_semi"), "dedup-left")
        number += 1
        if number > 1000:
            raise ValueError(f"{differing} texts still share a fingerprint; use more bases")


def exact_groups(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without ASCII white space; null counts as empty.  The row with the
    most code points stays, then the smallest doc_id (null last).  Of rows that repeat the kept
    one's id and length exactly one is kept.  An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, prime), "dedup-prints")
    proved = materialize(classes(docs, prints), "dedup-classes")
    n_proved = proved.count()
    # rows that repeat an id and a text are one row with a count, until the result deals them out again
    single = prints.groupBy("doc_id", "n_chars", *KEY, "text_sha256").agg(F.count("*").alias("times"))
    rows = single.join(small_side(proved, n_proved, 130), [*KEY, "text_sha256"], "left")
    rows = materialize(rows.withColumn("round", F.coalesce("round", F.lit(-1))), "dedup-rounds")
    order = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("id"))
    best = rows.where("round >= 0").groupBy(*KEY, "round").agg(F.min(order).alias("best"), F.sum("times").alias("size"))
    rows = rows.join(small_side(materialize(best, "dedup-best"), n_proved, 100), [*KEY, "round"], "left")
    wins = F.col("best").isNull() | ((F.col("n_chars") == -F.col("best.a")) & F.col("doc_id").eqNullSafe(F.col("best.id")))
    return rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("time")).select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (wins & (F.col("time") == 1)).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    rows = materialize(exact_groups(docs), "dedup-rows")
    return keep_rows(docs, rows)


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Apply ``rows`` (doc_id, kept, text_sha256, n_chars; one for each row of ``docs``) to ``docs``.

    Ids of which no row is kept leave by an anti-join; only ids that have kept and dropped rows
    are matched by text as well.
    """
    per_id = materialize(rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("k")), "dedup-ids")
    counted = per_id.agg(F.count(F.when(F.col("k") < F.col("n"), 1)).alias("lose"), F.count(F.when((F.col("k") > 0) & (F.col("k") < F.col("n")), 1)).alias("mixed")).first()
    packed = docs.select(F.col("doc_id").cast("long").alias("id"), whole_row(docs).alias("row"))
    losers = small_side(per_id.where("k < n").select(F.col("doc_id").alias("loser")), counted["lose"], 16)
    out = packed.join(losers, F.col("id").eqNullSafe(F.col("loser")), "left_anti")
    if counted["mixed"]:
        torn = per_id.where("k > 0 and k < n").select(F.col("doc_id").alias("torn"))
        kept = rows.where("kept").join(torn, F.col("doc_id").eqNullSafe(F.col("torn"))).select("torn", F.col("text_sha256").alias("sha"), F.col("n_chars").alias("chars"))
        text = F.coalesce(F.col("row")["text"].cast("string"), F.lit(""))
        tried = packed.select("id", "row", F.sha2(F.regexp_replace(text, f"[{WS}]+", ""), 256).alias("own_sha"), F.length(text).alias("own_chars"))
        chosen = tried.join(kept, F.col("id").eqNullSafe(F.col("torn")) & (F.col("own_sha") == F.col("sha")) & (F.col("own_chars") == F.col("chars"))).dropDuplicates(["id", "sha", "chars"])
        out = out.unionByName(chosen.select("id", "row"))
    return out.select("row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
k AS (SELECT doc_id, sha256(bare) AS text_sha256, first_value(doc_id) OVER w AS keep_id,
             count(*) OVER (PARTITION BY bare) AS group_size, row_number() OVER w AS place
      FROM d WINDOW w AS (PARTITION BY bare ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM k
"""
