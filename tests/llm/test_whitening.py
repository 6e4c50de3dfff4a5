import math

import numpy as np
import pytest

from tidemark.llm import queries, whitening
from tidemark.llm.common import read_table
from tidemark.llm.whitening import jacobi_davidson, minres, orthonormal, whiten

INF = float("inf")


def plain(vectors, k=16):
    """By the whole covariance and a dense solver, in whole numbers as far as they go."""
    x = np.floor(np.array(vectors, dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.astype(object).sum(axis=0)
    mean_whole = np.array([int(s) // n for s in sums])
    rest = np.array([(int(s) % n) / n for s in sums])
    centred = (fit - mean_whole) - rest
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    deviation = [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))) for row in x]
    return n, deviation, ((x - mean_whole) - rest) @ axes / np.sqrt(values), values, np.trace(centred.T @ centred / n)


def compare(rows, ids, vectors):
    n, deviation, whitened, values, trace = plain(vectors)
    k = len(values)
    found = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(found) == len(rows) == len(ids) * k
    for j in range(k):
        mine = np.array([found[i, j + 1]["whitened"] for i in ids])
        sign = np.sign((mine * whitened[:, j]).sum())
        np.testing.assert_allclose(mine * sign, whitened[:, j], atol=1e-8)
    for at, i in enumerate(ids):
        for j in range(k):
            row = found[i, j + 1]
            assert (row["n"], row["deviation"]) == (n, deviation[at])
            assert math.isclose(row["explained"], values[j] / trace, rel_tol=1e-9)
            assert row["identity_error"] < 1e-9


def test_query_equals_a_dense_solver(spark, sf_dir):
    table = read_table(spark, sf_dir, "embeddings").collect()
    rows = queries.op12_whitening(spark, sf_dir).collect()
    compare(rows, [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_copies_are_fitted_once_and_each_row_returns(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 5)) * [5, 3, 2, 1, 0.5]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    compare(whiten(df).collect(), [r[0] for r in rows], [r[1] for r in rows])


def test_unusable_rows_and_clashing_columns(spark):
    fine = [(i, [float(i), float(i * i % 7), 1.5]) for i in range(12)]
    rows = fine + [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 0.0])]
    rows += [(54, [INF, 0.0, 0.0]), (55, [1.0]), (56, [1e300, 0.0, 0.0]), (None, [3.0, 2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.selectExpr("*", "'x' AS component", "'y' AS n", "'z' AS _x", "'w' AS whitened")
    out = whiten(df).collect()
    # One dimension is the same everywhere but in the row without an id.
    assert {r["vec_id"] for r in out} == {*range(12), None}
    assert {r["component"] for r in out} == {1, 2, 3}
    assert {r["n"] for r in out} == {13}


def test_directions_without_variance_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert {r["component"] for r in whiten(df).collect()} == {1}
    for same in (df.limit(0), df.filter("vec_id = 3"), df.selectExpr("vec_id", "array() :: array<float> AS embedding")):
        out = whiten(same)
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]


def test_large_sums_stay_exact_or_null(spark):
    rows = [(i, [2.0**45 + 64.0 * i, float(i % 3)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    compare(whiten(df).collect(), [r[0] for r in rows], [r[1] for r in rows])
    far = spark.createDataFrame([(0, [-(2.0**45)]), (1, [2.0**45])], "vec_id bigint, embedding array<double>")
    assert {r["deviation"] for r in whiten(far).collect()} == {None}


@pytest.mark.parametrize("seed", range(4))
def test_jacobi_davidson_with_gaps_clusters_and_restarts(seed):
    rng = np.random.default_rng(seed)
    d = 300
    spectra = [np.geomspace(1e4, 1e-3, d), np.linspace(2, 1, d), np.r_[[5.0] * 10, np.ones(d - 10)], rng.random(d) * 20]
    spectrum = np.sort(spectra[seed])[::-1]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = (q * spectrum) @ q.T
    passes = []

    def product(block):
        passes.append(block.shape[1])
        return matrix @ block

    values, vectors = jacobi_davidson(product, d, 16)
    np.testing.assert_allclose(values, spectrum[:16], rtol=1e-11)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)
    residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
    assert residual.max() <= 10 * whitening.TOLERANCE * spectrum[0]
    assert max(passes) <= 2 * (16 + whitening.GUARD)


def test_minres_solves_indefinite_systems_side_by_side():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    matrix = (q * np.linspace(-3, 4, 30)) @ q.T
    rhs = np.hstack([rng.standard_normal((30, 3)), np.zeros((30, 1))])
    x = minres(lambda block: matrix @ block, rhs, 60, 1e-12)
    np.testing.assert_allclose(matrix @ x, rhs, atol=1e-8)


def test_orthonormal_drops_what_is_there_already():
    basis = np.eye(6)[:, :2]
    made = orthonormal(np.array([[1, 2, 3, 0, 0, 0], [1, 2, 3, 0, 0, 0], [4, 5, 0, 0, 0, 0.0]]).T, basis)
    assert made.shape == (6, 1)
    assert abs(made[2, 0]) == pytest.approx(1)
