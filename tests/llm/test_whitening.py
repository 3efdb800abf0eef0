import math

import numpy as np
import pytest

from scorelake.llm.whitening import eigen, exact_product, one_sided_jacobi, pivoted_cholesky, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n int"


def brute(rows, components=8):
    """By exact integers and numpy's own eigenvalues."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(kept), np.array([v for _, v in kept], object)
    sums = x.sum(axis=0)
    z = n * x - sums
    cov = (z.T @ z).astype(float) / float(n) ** 3 if n else np.zeros((0, 0))
    # z = n (x - mean), so z'z / n is n**2 times the covariance.
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    projected = (z.astype(float) / n) @ vectors[:, order] / np.sqrt(values[order])
    return kept, n, (z**2).sum(axis=1), projected, values[order] / np.trace(cov)


def check(got, rows):
    kept, n, deviation, projected, explained = brute(rows)
    assert len(got) == len(kept) * projected.shape[1]
    by_component = {}
    for r in got:
        by_component.setdefault(r["component"], []).append(r)
    for c, found in by_component.items():
        want = sorted((i is None, i or 0, d, w) for (i, _), d, w in zip(kept, deviation.tolist(), projected[:, c - 1].tolist()))
        have = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"], r["whitened"]) for r in found)
        other = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"], -r["whitened"]) for r in found)
        assert [x[:3] for x in want] == [x[:3] for x in have]
        one, flipped, right = (np.array([x[3] for x in rows]) for rows in (have, other, want))
        assert min(np.abs(one - right).max(), np.abs(flipped - right).max()) < 1e-8
        assert all(r["n"] == n and math.isclose(r["explained"], explained[c - 1], rel_tol=1e-9) and r["identity_error"] < 1e-9 for r in found)


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(whitened(table).collect(), [(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_edges(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300, None), (301, [None] + [0.5] * 11), (302, [math.nan] * 12), (303, [math.inf] + [0.0] * 11), (None, [0.25] * 12), (7, [1.0] * 12), (7, [1.0] * 12)]
    rows += [(400 + i, [9.0 * (i + 1)] * 12) for i in range(3)]
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(5)
    check(whitened(table).collect(), rows)
    # Vectors of a rare length and entries beyond a long are left out.
    odd = spark.createDataFrame([(900, [1.0, 2.0], 1, "x", 2), (901, [3e38] * 12, 1, "x", 2), (902, [], 1, "x", 2)], SCHEMA)
    check(whitened(table.union(odd)).collect(), rows)


def test_nothing_to_fit(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0)] * 3, SCHEMA)
    assert whitened(one).collect() == [] and whitened(one.where("false")).columns[0] == "vec_id"


def test_fewer_components_than_asked(spark):
    # Two directions only.
    rows = [(i, [float(i), float(2 * i), float(i % 5)]) for i in range(50)]
    got = whitened(spark.createDataFrame([(*r, 0, "", 0) for r in rows], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2} and math.isclose(sum({r["component"]: r["explained"] for r in got}.values()), 1)


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_factor_and_rotations(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(3 * n, n)) * np.logspace(0, -6, n)
    a = x.T @ x
    factor, order = pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=0, atol=1e-13 * a.max())
    assert np.allclose(np.triu(factor, 1), 0) and (np.diff(factor.diagonal()) <= 1e-12).all()
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned**2).sum(0))
    assert np.abs(turned.T @ turned / np.outer(norms, norms) - np.eye(len(norms))).max() < 1e-13
    values, vectors = eigen(a)
    # Small eigenvalues keep their digits, which numpy's own of the squared matrix do not: singular values of x do.
    assert np.allclose(values, np.linalg.svd(x, compute_uv=False) ** 2, rtol=1e-6)
    assert np.allclose(vectors * values @ vectors.T, a, rtol=0, atol=1e-13 * a.max())


def test_products_are_exact():
    y = np.array([[2**40, 3], [-(2**41), 2**40 + 1]])
    assert exact_product(y).tolist() == [[2**80 + 2**82, 3 * 2**40 - 2**41 * (2**40 + 1)], [3 * 2**40 - 2**41 * (2**40 + 1), 9 + (2**40 + 1) ** 2]]
    assert exact_product(np.array([[3, -4], [5, 6]])).tolist() == [[34, 18], [18, 52]]


def test_a_deviation_that_is_no_long_is_null(spark):
    rows = [(i, [1e7 * (i % 3), float(i % 7)]) for i in range(100)]
    got = whitened(spark.createDataFrame([(*r, 0, "", 0) for r in rows], SCHEMA)).collect()
    _, _, deviation, _, _ = brute(rows)
    assert len(got) == 200 and all(r["deviation"] == (d if (d := deviation[r["vec_id"]]) < 2**63 else None) for r in got)
    assert any(r["deviation"] is None for r in got)
