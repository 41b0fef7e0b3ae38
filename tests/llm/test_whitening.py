"""Whitening against dense eigenvectors and exact arithmetic."""

import numpy as np
import pytest

from lumenmart.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def made_up(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "even": np.linspace(1, 64, 64),
    "near pairs": np.concatenate([3 + 1e-9 * np.arange(5), np.linspace(4, 60, 30)]),
    "a cluster below 32 bits": np.concatenate([1 + 1e-10 * np.arange(12), [2, 2 + 1e-7, 2 + 2e-7]]),
    "equal": np.ones(9),
    "wide": 10.0 ** np.linspace(-8, 3, 40),
    "rank deficient": np.concatenate([np.zeros(5), np.linspace(1, 2, 6)]),
    "one": np.array([5.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenvectors_to_double_precision(name):
    a = made_up(SPECTRA[name])
    values, x = whitening.eigen(a)
    size = np.abs(values).max()
    wide = a.astype(np.longdouble) @ x.astype(np.longdouble) - x.astype(np.longdouble) * values
    assert np.abs(wide).max() <= 4e-16 * size
    assert np.abs(x.T @ x - np.eye(len(a))).max() <= 2e-15
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size and (np.diff(values) <= 0).all()


def test_refinement_starts_far_below_double_precision():
    a = made_up(SPECTRA["near pairs"])
    _, start = np.linalg.eigh(a.astype(np.float32))
    before = np.abs(a @ start.astype(float) - start.astype(float) * (start.astype(float) * (a @ start)).sum(0)).max()
    values, x = whitening.refined(a, start)
    assert before > 1e-7 and np.abs(a @ x - x * values).max() < 1e-13


def test_products_are_exact_to_extended_precision():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(30, 70)).astype(np.longdouble), rng.normal(size=(70, 20)).astype(np.longdouble) * np.longdouble(2) ** -30
    exact = np.array([[sum(int(x * 2**90) * int(y * 2**120) for x, y in zip(r, c, strict=True)) for c in b.T] for r in a], object)
    got = whitening.product(a, b)
    apart = max(abs(int(g * np.longdouble(2) ** 150) * 2**60 - int(e)) for g, e in zip(got.ravel(), exact.ravel(), strict=True))
    assert apart / 2**210 < 2.0**-30 * 1e-16


def test_query_equals_dense_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id", kind="stable")
    x = np.floor(64 * np.array(table.embedding.tolist(), np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    want = ((x - s / n) @ q) / np.sqrt(e)
    got = queries.op13_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    assert got.component.tolist() == list(range(1, 17)) * len(x)
    white = got.whitened.to_numpy().reshape(-1, 16)
    white = white * np.sign((white * want).sum(axis=0))
    assert np.abs(white - want).max() < 1e-9
    assert got.deviation.to_numpy().reshape(-1, 16)[:, 0].tolist() == ((n * x - s) ** 2).sum(axis=1).tolist()
    assert np.allclose(got.explained.to_numpy().reshape(-1, 16), e / np.trace(v), rtol=1e-9)
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, whitened string, found string")


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0, 5.0]), (1, [0.0, 1.0, 5.0]), (2, [1.0, 0.0, 5.0]), (3, None), (4, [1.0, None, 0.0]), (5, [nan, 0.0, 0.0])]
    rows += [(6, [inf, 0.0, 0.0]), (7, []), (8, [1.0, 2.0]), (None, [3.0, 3.0, 5.0])]
    got = whitening.whiten(vectors(spark, [(i, v, "x", "y") for i, v in rows])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted([(i, c) for i in (0, 1, 1, 2) for c in (1, 2, 3)])
    assert {r.n for r in got} == {3}  # equal vectors count once
    assert all((r.whitened is None) == (r.component == 3) for r in got)
    assert all(r.explained == 0 for r in got if r.component == 3) and got[0].identity_error < 1e-12
    x = np.array([[0, 64], [64, 0], [192, 192]])
    dev = ((3 * x - x.sum(0)) ** 2).sum(1).tolist()
    assert {(r.vec_id, r.deviation) for r in got} == {(1, dev[0]), (2, dev[1]), (None, dev[2])}


def test_no_spread_and_no_rows(spark):
    one = whitening.whiten(vectors(spark, [(1, [2.0, 3.0], "x", "y")] * 2)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, None), (2, 1, 0, None, 0.0, None)] * 2
    assert whitening.whiten(vectors(spark, [])).count() == 0


def test_entries_beyond_the_bound(spark):
    got = whitening.whiten(vectors(spark, [(1, [1e300], "", ""), (2, [-1e300], "", ""), (3, [0.0], "", "")])).collect()
    assert [r.deviation for r in got] == [None, None, 0] and abs(got[0].whitened - 1.5**0.5) < 1e-12
