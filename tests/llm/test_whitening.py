"""Whitening against numpy's eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctlens.llm.queries import op11_whitening
from acctlens.llm.whitening import Spectrum, rank_one, whiten
from tests.conftest import SF_MID

VECTORS = "vec_id long, embedding array<double>"


def brute(vectors, components):
    """(whitened up to signs, eigenvalue shares, deviations)"""
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    c = np.array(x, float) - np.array(s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, len(e))
    return (c @ v / np.sqrt(np.maximum(e, 1e-30)))[:, :k], (e / e.sum())[:k], deviation


def test_rank_one_updates_with_deflation():
    """Equal eigenvalues, zero weights, tiny and huge updates: the sum and orthogonality hold."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 40):
        d, v = np.sort(rng.random(n)) * 10, np.linalg.qr(rng.normal(size=(n, n)))[0]
        for k in range(40):
            if k % 10 == 3:
                d = np.full(n, d.mean())
            if k % 10 == 6:
                d = np.sort(np.where(np.arange(n) < n // 2, 0.0, d))
            x = v @ (rng.normal(size=n) * (rng.random(n) > 0.4)) * 10.0 ** rng.integers(-12, 5)
            want = (v * d) @ v.T + 1.7 * np.outer(x, x)
            d, v = rank_one(d, v, x, 1.7)
            assert np.abs((v * d) @ v.T - want).max() <= 1e-13 * max(1.0, np.abs(want).max())
            assert np.abs(v.T @ v - np.eye(n)).max() < 1e-13 * (k + 2)
            assert (np.diff(d) >= 0).all()


def test_joined_spectra_equal_one(spark):
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(300, 12)) * 50)
    parts = []
    for some in np.array_split(x, 7):
        s = Spectrum.empty(0)
        s.widen(12)
        for r in some:
            s.add(r, 1)
        s.sums = [int(c) for c in some.sum(axis=0)]
        parts.append(s)
    for s in parts[1:]:
        parts[0].join(s)
    scatter = np.cov(x.T, bias=True) * len(x)
    assert np.allclose((parts[0].vectors * parts[0].values) @ parts[0].vectors.T, scatter, rtol=1e-10, atol=1e-8)
    assert parts[0].sums == x.sum(axis=0).astype(int).tolist()


def check(spark, rows, components=32, df=None):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    white, shares, deviation = brute([list(v) + [0.0] * (width - len(v)) for _, v in good], components)
    got = whiten(spark.createDataFrame(rows, VECTORS) if df is None else df, components).collect()
    assert len(got) == len(good)
    order = lambda rows_: sorted(range(len(rows_)), key=lambda k: (str(rows_[k][0]), int(rows_[k][1])))
    a = order([(r.id, r.deviation) for r in got])
    b = order([(i, d) for (i, _), d in zip(good, deviation)])
    assert [int(got[k].deviation) for k in a] == [deviation[k] for k in b] and [got[k].id for k in a] == [good[k][0] for k in b]
    y = np.array([got[k].whitened for k in a], float)
    live = np.array([x is not None for x in got[0].whitened])
    sign = np.sign((y * white[b]).sum(axis=0))
    assert np.allclose(y[:, live], (white[b] * sign)[:, live], atol=1e-6)
    assert np.allclose(got[0].explained, shares, rtol=1e-4, atol=1e-12)
    assert all(r.identity_error <= 1e-8 and r.n == len(good) for r in got)
    return got


def test_bad_repeated_and_short_vectors_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(80)] + [(7, rows_) for rows_ in [[0.5] * 6] * 40]
    rows += [(100, None), (101, [float("nan")] + [0.0] * 5), (102, [None] + [1.0] * 5), (103, [float("inf")] * 6),
             (None, rng.normal(size=6).tolist()), (104, [0.25, -3.0]), (105, [])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("id", "v", "n", "whitened", "slot", "mean")})
    check(spark, rows, df=df)


def test_fewer_components_than_dimensions(spark):
    rng = np.random.default_rng(4)
    check(spark, [(i, (rng.normal(size=9) * np.arange(1, 10)).tolist()) for i in range(200)], components=4)


def test_flat_components_are_null(spark):
    """One vector, equal vectors, and vectors on a line."""
    got = whiten(spark.createDataFrame([(1, [1.0, 2.0])], VECTORS)).collect()
    assert got[0].whitened == [None, None] and got[0].explained == [None, None] and got[0].identity_error == 0 and got[0].deviation == 0
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(50)]
    got = whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None and r.whitened[2] is None for r in got)
    assert got[0].explained[0] == pytest.approx(1) and got[0].identity_error < 1e-9


def test_huge_entries_and_exact_deviation(spark):
    rows = [(i, [float(2 ** 40 + 977 * i), float(i % 3)]) for i in range(30)]
    _, _, deviation = brute([v for _, v in rows], 2)
    got = whiten(spark.createDataFrame(rows + [(99, [1e300, 0.0])], VECTORS)).collect()
    assert sorted((r.id, int(r.deviation)) for r in got) == [(i, d) for (i, _), d in zip(rows, deviation)]


def test_empty_tables(spark):
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([(1, []), (2, None)], VECTORS)).count() == 0


def test_query_on_the_table(spark):
    got = op11_whitening(spark, SF_MID).toPandas()
    vectors = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "embedding").collect()
    white, shares, deviation = brute([[float(c) for c in r.embedding] for r in vectors], 32)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in vectors]].to_numpy()
    assert np.allclose(wide, white * np.sign((wide * white).sum(axis=0)), atol=1e-8)
    first = got[got.component == 1].set_index("vec_id")
    assert first.deviation.loc[[r.vec_id for r in vectors]].tolist() == deviation
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, shares, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() <= 1e-10
