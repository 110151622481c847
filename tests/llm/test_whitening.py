"""Whitening against numpy, and block Lanczos on matrices that are hard for it."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import whitening
from chunkloom.llm.queries import op13_whitening


def eigen(matrix, k):
    values, vectors = np.linalg.eigh(matrix)
    return values[::-1][:k], vectors[:, ::-1][:, :k]


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        1.0 / np.arange(1, 401),  # a falling tail
        [5.0] * 40 + [1.0] * 160,  # more copies of one value than a block has columns
        [3.0, 2.0, 1.0] + [0.0] * 97,  # far fewer values than are wanted
        [0.0] * 50,
        [2.0],
        1e6 * 0.97 ** np.arange(300),
        [100.0, *(1 + 1e-3 * np.arange(250)[::-1])],
    ],
)
def test_block_lanczos(values):
    matrix = symmetric(values)
    calls = []

    def apply(block):
        calls.append(block.shape[1])
        return matrix @ block

    found, vectors, rounds = whitening.block_lanczos(apply, len(values), 32, block=8)
    k = min(32, len(values))
    top = max(abs(np.array(values)).max(), 1e-300)
    assert np.allclose(found, sorted(values)[::-1][:k], atol=1e-12 * top, rtol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() <= 1e-12 * top + 1e-300
    assert rounds == len(calls) and max(calls) <= 8


def test_a_basis_past_its_bound_is_cut_back():
    values = 0.99 ** np.arange(600)
    matrix = symmetric(values, 1)
    widths = []
    found, vectors, rounds = whitening.block_lanczos(lambda b: widths.append(b.shape) or matrix @ b, 600, 32, block=8, spare=24)
    assert np.allclose(found, values[:32], rtol=1e-11) and rounds < 200
    want = eigen(matrix, 32)[1]
    assert np.abs(np.abs((want * vectors).sum(axis=0)) - 1).max() < 1e-10
    with pytest.raises(RuntimeError, match="rounds"):
        whitening.block_lanczos(lambda b: matrix @ b, 600, 32, block=8, rounds=3)


def brute(rows, k=32):
    x = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, d = len(x), len(x[0][1])
    s = [sum(v[j] for _, v in x) for j in range(d)]
    deviations = [sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)) for _, v in x]
    centred = np.array([[float(n * a - b) / n for a, b in zip(v, s, strict=True)] for _, v in x])
    cov = centred.T @ centred / n
    values, vectors = eigen(cov, min(k, d))
    kept = values > 1e-12 * values[0]
    return [i for i, _ in x], n, deviations, (centred @ vectors / np.sqrt(np.where(kept, values, 1)))[:, kept], (values / np.trace(cov))[kept]


def compare(rows, got):
    ids, n, deviations, white, explained = brute(rows)
    k = white.shape[1]
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n}
    found = {}
    for r in got:
        found.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    assert sorted(map(str, ((i, d) for i, d in zip(ids, deviations, strict=True)))) == sorted(str(key) for key, v in found.items() for _ in v[1])
    shares = {r["component"]: r["explained"] for r in got}
    assert sorted(shares) == list(range(1, k + 1)) and np.allclose([shares[c + 1] for c in range(k)], explained, rtol=1e-9)
    mine = np.array([[found[i, d][c + 1][0] for c in range(k)] for i, d in zip(ids, deviations, strict=True)])
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * signs - white).max() < 1e-7
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_against_numpy(spark, folder):
    rows = duckdb.sql(f"select vec_id, embedding from '/root/testdata/{folder}/embeddings.parquet'").fetchall()
    compare(rows, op13_whitening(spark, f"/root/testdata/{folder}").collect())


KIND = "vec_id long, embedding array<float>, label int, x string, n string, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "a", None, "b") for i, v in rows], KIND)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.standard_normal(5)]) for i in range(40)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, None), (50, None), (51, [1.0, 2.0, None, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [0.0, float("-inf"), 0.0, 0.0, 0.0]), (54, [1e4, -1e4, 0.0, 5.0, -0.01])]
    compare(rows, whitening.whiten(table(spark, rows).repartition(4)).collect())


def test_vectors_of_a_plane_have_two_components(spark):
    rows = [(i, [float(i % 7), float(i % 3), float(i % 7)]) for i in range(21)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2}
    compare(rows, got)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(table(spark, rows))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_deviations_are_exact_or_refused():
    few = whitening.Moments(1_000_003, [1_000_003 * 1_000_000 + 17, -5])
    x = np.array([[1_000_900, 3], [999_000, -4]])
    want = [sum((1_000_003 * int(a) - s) ** 2 for a, s in zip(v, (1_000_003 * 1_000_000 + 17, -5), strict=True)) for v in x]
    assert few.deviations(x) == want
    near = whitening.Moments(3_000_000_000, [0, 0])  # the bound is passed, the sum is not
    assert near.deviations(np.array([[0, 1]])) == [9 * 10**18]
    with pytest.raises(OverflowError):
        near.deviations(np.array([[1, 1]]))
