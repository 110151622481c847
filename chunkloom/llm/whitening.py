"""Whitening of embeddings by their leading principal components, found without forming the covariance.

Block Lanczos: each round one distributed pass over the centred vectors gives the covariance times a block of directions; what is new in the
product, made orthogonal to all directions so far (twice, so that rounding does not creep in), is the next block.  The covariance seen on these directions
is a small matrix whose eigenvectors (Ritz vectors) near the wanted ones.  Where a block loses rank, because the directions so far hang together or
an eigenvalue is repeated, random directions take the place of what is lost.  A basis that grows past its bound is cut back to the best Ritz vectors
and goes on from what they lack.  Rounds end when that lack, the residual of every wanted vector, is rounding, or when the directions span the space.

Only matrices of dimensions by directions reach the driver: their size does not depend on the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialize

#: Entries c become whole numbers floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS, BLOCK = 32, 16
#: Directions held on the driver beyond the wanted ones.
SPARE = 96
#: A residual of this part of the largest eigenvalue counts as rounding; variances below RANK of it as none.
RESIDUAL, RANK = 1e-13, 1e-12
ROUNDS = 500
#: Rounds from random directions after all residuals are rounding: what a block's own directions cannot reach, as further copies of an eigenvalue, shows there.
PROBES = 3
SEED = 42

Apply = Callable[[np.ndarray], np.ndarray]


def _fresh(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``block`` made orthonormal and orthogonal to ``basis``; lost columns are replaced by random ones while the space has room."""
    room = min(block.shape[1], basis.shape[0] - basis.shape[1])
    out = np.zeros((basis.shape[0], 0))
    candidates = [*block.T]
    while out.shape[1] < room:
        v = candidates.pop(0) if candidates else rng.standard_normal(basis.shape[0])
        size = np.linalg.norm(v)
        for _ in range(2):
            v = v - basis @ (basis.T @ v)
            v = v - out @ (out.T @ v)
        left = np.linalg.norm(v)
        if size > 0 and left > 1e-10 * size:
            v = v / left
            v = v - basis @ (basis.T @ v) - out @ (out.T @ v)
            out = np.column_stack([out, v / np.linalg.norm(v)])
    return out


def block_lanczos(apply: Apply, dimensions: int, wanted: int, block: int = BLOCK, spare: int = SPARE, seed: int = SEED, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """(eigenvalues, unit eigenvectors as columns, rounds) of the ``wanted`` largest eigenvalues, falling, of the symmetric matrix that ``apply`` multiplies by.

    RuntimeError if the residuals are not down to rounding after ``rounds`` rounds.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dimensions)
    basis, image, quiet = np.zeros((dimensions, 0)), np.zeros((dimensions, 0)), 0
    new = _fresh(rng.standard_normal((dimensions, min(block, dimensions))), basis, rng)
    for number in range(1, rounds + 1):
        product = apply(new)
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product])
        seen = basis.T @ image
        values, turn = np.linalg.eigh((seen + seen.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, images = basis @ turn, image @ turn
        lack = images - vectors * values
        rest = np.linalg.norm(lack[:, :wanted], axis=0)
        quiet = quiet + 1 if basis.shape[1] > wanted and bool(np.all(rest <= RESIDUAL * max(values[0], 0.0))) else 0
        if basis.shape[1] >= dimensions or quiet > PROBES:
            return values[:wanted], vectors[:, :wanted] / np.linalg.norm(vectors[:, :wanted], axis=0), number
        if basis.shape[1] + block > wanted + spare + block:
            keep = wanted + spare // 2
            basis, image = vectors[:, :keep], images[:, :keep]
        # what the least settled of the wanted vectors lack is in the span of the last product, and after a cut it is all that leads on
        if quiet == 1:
            product = rng.standard_normal(product.shape)
        elif not quiet and basis.shape[1] >= wanted:
            product = lack[:, np.argsort(-rest)[:block]]
        new = _fresh(product, basis, rng)
    raise RuntimeError(f"residuals of up to {rest.max():.3g} after {rounds} rounds")


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    """The whole numbers of a batch's vectors, a row each."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _fits(largest: int) -> bool:
    return largest < 1 << 63


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): vectors that have no null, NaN or infinite entry, as whole numbers; others, and null ones, are left out."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    good = rows.where(F.col("c").isNotNull() & F.forall("c", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))  # NaN is larger than any number
    return good.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + OFFSET).alias("x"))


def sums(vectors: DataFrame, dimensions: int) -> list[int]:
    """The exact sum of each dimension: a row for each dimension and task is shuffled."""

    def rows(batches: Batches):
        total = [0] * dimensions
        for batch in batches:
            x = _matrix(batch, dimensions)
            own = x.sum(axis=0) if not len(x) or _fits(len(x) * int(np.abs(x).max())) else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, own, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["place", "total"])

    found = vectors.select("x").mapInArrow(rows, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total")).collect()
    return [int(r["total"]) for r in sorted(found)]


def products(vectors: DataFrame, made: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], dimensions: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all vectors of leftᵀ right, where ``made`` gives (left, right) of a batch's matrix; ``shape`` is that of the sum.

    Each task sends its sum, a row for each row of the matrix.
    """
    height, width = shape

    def rows(batches: Batches):
        total = np.zeros(shape)
        for batch in batches:
            left, right = made(_matrix(batch, dimensions))
            total += left.T @ right
        yield pa.RecordBatch.from_arrays([pa.array(range(height), pa.int32()), *(pa.array(total[:, k]) for k in range(width))], names=["place", *(f"p{k}" for k in range(width))])

    kinds = ", ".join(f"p{k} double" for k in range(width))
    parts = vectors.select("x").mapInArrow(rows, f"place int, {kinds}")
    found = parts.groupBy("place").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(width)]).collect()
    out = np.zeros(shape)
    for r in found:
        out[r["place"]] = r[1:]
    return out


class Moments:
    """How many vectors there are, and the exact sums of their dimensions."""

    def __init__(self, n: int, total: list[int]):
        self.n, self.dimensions = n, len(total)
        # a mean is its whole part and a rest below 1, so that what is near it keeps all its digits
        self.whole, self.over = np.array([t // n for t in total], np.int64), np.array([t % n for t in total], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.over / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """For each row the sum of (n * x - S)**2, exact."""
        apart = x - self.whole
        if not len(x) or _fits(self.dimensions * (self.n * (int(np.abs(apart).max()) + 1)) ** 2):
            return ((self.n * apart - self.over) ** 2).sum(axis=1).tolist()
        found = ((self.n * apart.astype(object) - self.over.astype(object)) ** 2).sum(axis=1).tolist()
        if not _fits(max(found)):
            raise OverflowError("the deviation of a vector does not fit a long")
        return found


class Whitening:
    """What is fitted to the vectors: components by falling variance, and the share of all variance that each explains."""

    def __init__(self, moments: Moments, values: np.ndarray, vectors: np.ndarray, trace: float, rounds: int):
        self.moments, self.values, self.vectors, self.trace, self.rounds = moments, values, vectors, trace, rounds
        self.explained, self.turn = values / trace, vectors / np.sqrt(values)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ self.turn


def _with_deviations(vectors: DataFrame, moments: Moments) -> DataFrame:
    def rows(batches: Batches):
        for batch in batches:
            yield batch.append_column("deviation", pa.array(moments.deviations(_matrix(batch, moments.dimensions)), pa.int64()))

    return vectors.mapInArrow(rows, "vec_id long, x array<long>, deviation long")


def fit(embeddings: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> tuple[DataFrame, Whitening | None]:
    """(vectors, whitening): the vectors (vec_id, x, deviation) as a written table, and what is fitted to all of them.

    None if there is no vector, or no two that differ.  ValueError if their lengths differ.
    """
    held = materialize(whole_numbers(embeddings), "whitening-vectors")
    about = held.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if not about["n"] or not about["high"]:
        return held.withColumn("deviation", F.lit(0).cast("long")), None
    if about["low"] != about["high"]:
        raise ValueError(f"vectors of {about['low']} to {about['high']} entries")
    moments = Moments(about["n"], sums(held, about["high"]))
    held = materialize(_with_deviations(held, moments), "whitening-exact")
    # whole numbers up to here, so the trace does not depend on the order of adding
    trace = int(held.agg(F.sum(F.col("deviation").cast("decimal(38,0)")).alias("t")).first()["t"]) / moments.n**3
    if not trace:
        return held, None

    def apply(directions: np.ndarray) -> np.ndarray:
        def made(x: np.ndarray):
            centred = moments.centred(x)
            return centred, centred @ directions

        return products(held, made, moments.dimensions, directions.shape) / moments.n

    values, vectors, rounds = block_lanczos(apply, moments.dimensions, components, block)
    kept = values > RANK * values[0]
    return held, Whitening(moments, values[kept], vectors[:, kept], trace, rounds)


def identity_error(vectors: DataFrame, how: Whitening) -> float:
    """The largest entry by size of the whitened vectors' covariance minus the identity, from one more pass over all of them."""
    k = len(how.values)

    def made(x: np.ndarray):
        w = np.column_stack([how.whitened(x), np.ones(len(x))])
        return w, w

    found = products(vectors, made, how.moments.dimensions, (k + 1, k + 1)) / how.moments.n
    mean = found[k, :k]
    return float(np.abs(found[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector of ``embeddings`` (vec_id, embedding) and component: vec_id, component (from 1), n, deviation, whitened, explained and identity_error.

    Vectors that are null or hold a null, NaN or infinite entry are left out.  Components without variance are none, so
    copies of a single vector, and an empty table, give an empty result.  Repeated rows count as often as they stand there; null ids stay null.  Eigenvalues
    that are equal have any orthonormal vectors of their space.  Other columns are not looked at, whatever their names.  OverflowError if a deviation
    does not fit a long, as with more than some 5 million vectors of 64 entries of about 1; ArithmeticException for entries beyond a long.
    """
    held, how = fit(embeddings, components)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if how is None:
        return embeddings.sparkSession.createDataFrame([], kinds)
    error, k = identity_error(held, how), len(how.values)

    def rows(batches: Batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                own = batch.slice(start, 2048)
                m = own.num_rows
                every = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("vec_id").take(pa.array(every)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, how.moments.n, np.int64)),
                        own.column("deviation").take(pa.array(every)),
                        pa.array(how.whitened(_matrix(own, how.moments.dimensions)).ravel()),
                        pa.array(np.tile(how.explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return held.mapInArrow(rows, kinds)
