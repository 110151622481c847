"""Packing into length buckets whose bounds dynamic programming chooses."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, materialize, quoted

BUCKETS = 12
BATCH_TOKENS = 16_384
#: Rows of a bucket that one task lays out at most, about.
SHARD_ROWS = 50_000
MADE = ("n_tokens", "bucket", "bucket_tokens", "shard", "batch", "slot", "padding")
ROW, NUMBER = "__pack_row", "__pack_number"


def n_tokens(text: str = "text"):
    """Words of the text and one end token."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), f"[{WS}]+"), "")).cast("long") + 1


def best_bounds(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that pad the fewest tokens, by dynamic programming over exact lengths.

    ``cost[j]`` is the least padding of the j shortest lengths with one bucket more at each turn.  A bucket over lengths
    i..j-1 adds longest * (docs[j] - docs[i]) - (tokens[j] - tokens[i]): for a given j a line in ``longest`` for each i, with slopes that
    fall as i grows.  Only lines on the lower hull can win, and the winner moves one way, so a turn takes linear time.
    """
    pairs = sorted(zip(lengths, counts, strict=True))
    docs, tokens = [0], [0]
    for length, count in pairs:
        docs.append(docs[-1] + int(count))
        tokens.append(tokens[-1] + int(length) * int(count))
    n = len(pairs)
    cost: list[int | None] = [0] + [None] * n
    cuts: list[list[int]] = []
    for _ in range(min(buckets, n)):
        new: list[int | None] = [0] + [None] * n
        cut = [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # slope, height, i
        front = 0
        for j in range(1, n + 1):
            if cost[j - 1] is not None:
                line = (-docs[j - 1], cost[j - 1] + tokens[j - 1], j - 1)
                while len(hull) - front >= 2 and _hidden(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            longest = int(pairs[j - 1][0])
            while len(hull) - front >= 2 and hull[front + 1][0] * longest + hull[front + 1][1] <= hull[front][0] * longest + hull[front][1]:
                front += 1
            slope, height, cut[j] = hull[front]
            new[j] = slope * longest + height + longest * docs[j] - tokens[j]
        cost = new
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(pairs[j - 1][0]))
        j = cut[j]
    return bounds[::-1]


def _hidden(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether line ``b``, of a slope between those of ``a`` and ``c``, is nowhere below both."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep``, n_tokens, bucket, bucket_tokens, shard, batch, slot and padding.

    A batch is the rows of one (bucket, shard, batch); all are padded to bucket_tokens, the length of the bucket's longest
    row, and together they fit batch_tokens.  A bucket whose documents alone exceed that has batches of one.  Large
    buckets are dealt into shards at random, each laid out in random order by one task, and only a shard's last batch can be short.
    Chance goes by rows, so rows that repeat each other, such as the copies that mixing makes, come together no more often than others.
    Null and empty texts have one token, the end.  Repeated rows take a slot each.  Columns of ``keep`` may have any name
    but those made here, which raise.  An empty table gives an empty result.

    The driver holds the histogram of lengths.  Documents of d different lengths have d**2 / 2 tokens or more, so it has
    sqrt(2 * tokens) rows at most: five million for fifteen trillion tokens.
    """
    if clash := set(keep) & set(MADE):
        raise ValueError(f"columns {sorted(clash)} are made here")
    kept = [quoted(c) for c in keep]
    # the number that decides a row's place is written with it, so a task that is run again deals out the same
    sized = materialize(docs.select(*kept, n_tokens(text).alias("n_tokens"), F.monotonically_increasing_id().alias(ROW)), "pack-lengths")
    counted = sized.groupBy("n_tokens").count().toPandas()
    bounds = best_bounds(counted["n_tokens"].tolist(), counted["count"].tolist(), buckets) or [1]
    in_bucket = np.searchsorted(np.array(bounds), counted["n_tokens"].to_numpy())
    rows = np.bincount(in_bucket, counted["count"].to_numpy(), len(bounds)) if len(counted) else np.zeros(len(bounds))
    shards = [max(1, -(-int(r) // SHARD_ROWS)) for r in rows]
    table = lambda values: F.array(*[F.lit(int(v)) for v in values])
    size = F.col("n_tokens")
    bucket = F.lit(0)
    for bound in bounds[:-1]:
        bucket = bucket + (size > bound).cast("int")
    placed = sized.withColumn("bucket", bucket).withColumn("bucket_tokens", F.get(table(bounds), F.col("bucket")).cast("long"))
    chance = F.xxhash64(F.lit("shard"), ROW)
    placed = placed.withColumn("shard", F.pmod(chance, F.get(table(shards), F.col("bucket"))).cast("int"))
    order = Window.partitionBy("bucket", "shard").orderBy(F.xxhash64(F.lit("place"), ROW), ROW)
    number = placed.withColumn(NUMBER, F.row_number().over(order) - 1)
    room = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket_tokens")).cast("int"))
    return number.select(
        *kept,
        "n_tokens",
        "bucket",
        "bucket_tokens",
        "shard",
        F.floor(F.col(NUMBER) / room).cast("long").alias("batch"),
        (F.col(NUMBER) % room).cast("long").alias("slot"),
        (F.col("bucket_tokens") - size).alias("padding"),
    )
