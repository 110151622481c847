"""Packing: bounds over exact lengths against all choices and a plain dynamic programme; chance placement of repeated rows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import packing


def padding(bounds, pairs):
    return sum(c * (next(b for b in bounds if b >= x) - x) for x, c in pairs)


def plain(pairs, buckets):
    """Least padding by the quadratic programme."""
    cost = [0] + [None] * len(pairs)
    for _ in range(buckets):
        new = [0] + [None] * len(pairs)
        for j in range(1, len(pairs) + 1):
            new[j] = min(cost[i] + sum(c * (pairs[j - 1][0] - x) for x, c in pairs[i:j]) for i in range(j) if cost[i] is not None)
        cost = new
    return cost[-1]


@pytest.mark.parametrize("buckets", [1, 2, 3, 7])
def test_bounds_are_the_best_for_long_documents_too(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(15):
        lengths = sorted(set(rng.integers(1, 60_000, 40).tolist() + rng.integers(2040, 2060, 5).tolist()))
        pairs = list(zip(lengths, rng.integers(1, 50, len(lengths)).tolist(), strict=True))
        bounds = packing.best_bounds(*zip(*pairs, strict=True), buckets)
        assert len(bounds) <= buckets and bounds[-1] == lengths[-1] and set(bounds) <= set(lengths)
        assert padding(bounds, pairs) == plain(pairs, buckets)


def test_bounds_take_time_in_proportion():
    lengths = np.arange(1, 100_001)
    assert len(packing.best_bounds(lengths.tolist(), (1_000_000 // lengths + 1).tolist(), 12)) == 12


def test_bucket_tokens_is_the_longest_row(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") * F.col("id") / 10).cast("int")).alias("text"))
    rows = packing.pack(docs, buckets=5).collect()
    longest = {}
    for r in rows:
        longest[r["bucket"]] = max(longest.get(r["bucket"], 0), r["n_tokens"])
    assert all(r["bucket_tokens"] == longest[r["bucket"]] for r in rows) and max(longest.values()) > 2048


def test_copies_meet_no_more_often_than_chance(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 500)
    # a third of the rows are one row again and again; the others come in threes
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.floor(F.col("id") / 3)).alias("doc_id"), F.lit("four words of text").alias("text"))
    rows = packing.pack(docs, batch_tokens=50).collect()
    batches, shards = {}, Counter()
    for r in rows:
        batches.setdefault((r["shard"], r["batch"]), []).append(r["doc_id"])
        shards[r["shard"], r["doc_id"] == -1] += 1
    assert len({s for s, hot in shards if hot}) == 6 and max(n for (_, hot), n in shards.items() if hot) < 250
    together = sum(n > 1 for b in batches.values() for i, n in Counter(b).items() if i != -1)
    assert together < 15  # of 667 triples in 300 batches of ten: some six by chance
    assert len({(r["shard"], r["batch"], r["slot"]) for r in rows}) == 3000


def test_names_that_are_made_here_raise(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, slot long")
    assert packing.pack(docs).count() == 1
    with pytest.raises(ValueError):
        packing.pack(docs, keep=("doc_id", "slot"))
