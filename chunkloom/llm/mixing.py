"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, materialize, whole_row

SEED = "mix-1"
#: The query's target weights: twice the share of an ordinary source for one, half of it for another.
TARGETS = {"src1": 2.0, "src2": 0.5}
#: A larger rate is drawn as the sum of several draws of equal rates below this (sums of Poisson draws are Poisson
#: draws), so the table of a source has a bounded length however often its rows repeat.
DRAW_RATE = 32.0
MADE = ("copy_no", "mix_key")
#: Parts that a source's rows are dealt in where the table of sources is too large for a broadcast.
SALTS = 64


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the seed and the parts."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def poisson_steps(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... as an array, as far as it differs from 1; ``rate`` is bounded."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("lp"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("out"))

    def step(acc, k):
        lp = acc["lp"] + F.ln(rate / k)
        c = acc["c"] + F.exp(lp)
        return F.struct(lp.alias("lp"), c.alias("c"), F.concat(acc["out"], F.array(c)).alias("out"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["out"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def target_rates(docs: DataFrame, weights: Mapping[str | None, float] | None, others: float, power: float, total: int | None) -> tuple[DataFrame, int]:
    """(source, rate, draws, steps) for each source, and the bytes they take.

    ``weights`` names the weight of some sources, ``others`` is that of each of the rest, and a source's share of the result is its
    weight's share of all; without ``weights`` shares go as the source's row count to ``power``.  ``total`` is the expected number
    of rows that come out; as many as go in by default.
    """
    counts = materialize(docs.groupBy(F.col("source").cast("string").alias("source")).count().withColumnRenamed("count", "n"), "mix-counts")
    if weights is None:
        weight = F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        weight = F.lit(float(others))
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(w)).otherwise(weight)
    weighed = counts.withColumn("w", weight)
    sums = weighed.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    budget, whole = float(total if total is not None else sums["n"] or 0), sums["w"] or 1.0
    rated = weighed.withColumn("rate", F.lit(budget) * (F.col("w") / F.lit(whole)) / F.col("n"))
    drawn = rated.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / DRAW_RATE)).cast("long"))
    rates = drawn.withColumn("steps", poisson_steps(F.col("rate") / F.col("draws"))).select("source", "rate", "draws", "steps")
    size = rates.agg(F.coalesce(F.sum(64 + F.coalesce(F.octet_length("source"), F.lit(0)) + 8 * F.size("steps")), F.lit(0))).first()[0]
    return rates, size


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5, total: int | None = None, seed: str = SEED, others: float = 0.0, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Each row of ``docs`` as often as its draw says, in a random order, with ``copy_no`` (from 1) and ``mix_key``.

    The draw inverts the Poisson distribution of the source's rate at a number hashed from seed, doc_id and text, so it is the same on every
    run; only rows that repeat both share a draw.  Null sources are a source of their own; a null id or
    text draws as the word "null" does.  Rows with a draw of 0 do not come out.  Columns named copy_no or
    mix_key in ``docs`` give way; others may have any name.  Texts may be of any length.  An empty table gives an empty result.
    """
    rates, size = target_rates(docs, weights, others, power, total)
    rates = rates.select(F.col("source").alias("of_source"), "draws", "steps")
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("null")))
    packed = docs.select(F.col("source").cast("string").alias("source"), F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text).alias("id"), whole_row(docs, MADE).alias("row"))
    same = F.col("source").eqNullSafe(F.col("of_source"))
    if size <= broadcast_bytes:
        drawn = packed.join(F.broadcast(rates), same)
    else:  # a source may hold a third of all rows: it is dealt in parts, and the small table repeated for each
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = packed.withColumn("part", F.pmod(F.hash("id"), F.lit(SALTS))).join(salted, same & (F.col("part") == F.col("salt")))

    def drawn_once(draw):
        u = uniform(seed, F.col("id"), draw)
        return F.size(F.filter("steps", lambda c: c <= u)).cast("long")

    times = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("draws")), F.lit(0).cast("long"), lambda n, draw: n + drawn_once(draw))
    counted = drawn.select("id", "row", times.alias("times")).where("times > 0")
    copies = counted.select("id", "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy_no"))
    keyed = copies.select("row", "copy_no", uniform(seed + "/order", F.col("id"), F.col("copy_no")).alias("mix_key"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shuffled = keyed.repartition(parts, F.hash("mix_key")).sortWithinPartitions("mix_key")
    return shuffled.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in MADE], "copy_no", "mix_key")


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """What ``mix`` gives, with the columns of ``docs`` alone."""
    mixed = mix(docs.select(whole_row(docs).alias("row"), "doc_id", "source", "text"), **how)
    return mixed.select("row.*")


def _u(seed: str, parts: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {parts}), 1, 13))::BIGINT / 4503599627370496.0"


_WEIGHT = "CASE source " + " ".join(f"WHEN '{name}' THEN {w}" for name, w in TARGETS.items()) + " ELSE 1.0 END"
ORACLE_SQL = f"""
WITH RECURSIVE n AS (SELECT source, count(*) AS n, ({_WEIGHT})::DOUBLE AS w FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n)::DOUBLE * (w / (SELECT sum(w) FROM n)) / n AS rate FROM n),
q AS (SELECT source, greatest(1, ceil(rate / {DRAW_RATE}))::BIGINT AS draws, rate / greatest(1, ceil(rate / {DRAW_RATE})) AS rate FROM r),
s AS (SELECT source, rate, 0 AS k, -rate AS lp, exp(-rate) AS c FROM q
      UNION ALL
      SELECT source, rate, k + 1, lp + ln(rate / (k + 1)), c + exp(lp + ln(rate / (k + 1))) FROM s WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
d AS (SELECT doc_id, source, text, doc_id::VARCHAR || ':' || md5(coalesce(text, 'null')) AS id, unnest(range(1, draws + 1)) AS draw FROM documents JOIN q USING (source)),
u AS (SELECT *, {_u(SEED, "id || ':' || draw::VARCHAR")} AS u FROM d),
t AS (SELECT doc_id, source, text, id, sum((SELECT count(*) FROM s WHERE s.source = u.source AND s.c <= u.u)) AS times FROM u GROUP BY ALL),
e AS (SELECT doc_id, source, text, id, unnest(range(1, times::BIGINT + 1)) AS copy_no FROM t)
SELECT doc_id, source, text, copy_no, round({_u(SEED + "/order", "id || ':' || copy_no::VARCHAR")}, 9) AS mix_key FROM e
"""
