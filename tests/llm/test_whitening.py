"""Whitening against numpy's decomposition of the exact covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from attrition.llm import whitening as W
from attrition.llm.whitening import Spectrum, WhiteningOptions

EMBEDDINGS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType())])


def integers(rows):
    """(vec_id, x) of the usable rows."""
    good = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in good]


def plain(rows, components=16):
    usable = integers(rows)
    fit = np.array(sorted({tuple(x) for _, x in usable}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    off = ((n * fit - total) / n).astype(float)
    cov = off.T @ off / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > len(total) * 1e-14 * values[0]).sum()))
    out = {}
    for i, x in usable:
        far = n * np.array(x, dtype=object) - total
        y = (far / n).astype(float) @ vectors[:, :keep] / np.sqrt(values[:keep])
        out.setdefault(i, []).append((int((far * far).sum()), y))
    return n, out, values[:keep] / np.trace(cov)


def compare(df, rows, components=16, least_gap=1e-6):
    n, expected, explained = plain(rows, components)
    got = {}
    result = df.collect()
    for r in result:
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
        got.setdefault(r.vec_id, []).append(r)
    assert set(got) == set(expected)
    signs = {}
    for i, rs in got.items():
        assert len(rs) == len(explained) * len(expected[i])
        if len(expected[i]) > 1:
            continue
        deviation, y = expected[i][0]
        for r in rs:
            assert r.deviation == deviation
            value = y[r.component - 1]
            if abs(value) > 1e-3:
                sign = signs.setdefault(r.component, np.sign(value) * np.sign(r.whitened))
                assert r.whitened * sign == pytest.approx(value, rel=1e-8, abs=1e-8)
    return result


def vectors(n, d, seed=0, falling=True):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    scale = 0.9 ** np.arange(d) if falling else np.ones(d)
    return [(i, [float(np.float32(c)) for c in row], 1) for i, row in enumerate((rng.normal(size=(n, d)) * scale) @ turn + 0.3)]


@pytest.mark.parametrize("d,n,rows", [(24, 300, 40), (5, 60, 10_000), (40, 30, 7)])
def test_report_equals_numpy(spark, d, n, rows):
    data = vectors(n, d)
    df = spark.createDataFrame(data, EMBEDDINGS).repartition(4)
    compare(W.whitening_report(df, WhiteningOptions(rows=rows, fan=3)), data)


def test_copies_and_unusable_rows(spark):
    data = vectors(80, 6, 3)
    rows = data + [(100 + i, data[5][1], 0) for i in range(200)]  # a common vector is in the fit list once
    rows += [(400, None, 1), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (402, [math.nan] * 6, 1), (403, [1.0, math.inf, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(404, [1.0, 2.0], 1), (405, [], 1), (7, data[9][1], 1), (None, data[4][1], None)]
    compare(W.whitening_report(spark.createDataFrame(rows, EMBEDDINGS), WhiteningOptions(rows=20)),
            [r for r in rows if r[1] is None or len(r[1]) == 6])


def test_extra_columns(spark):
    data = vectors(30, 4, 8)
    schema = T.StructType([*EMBEDDINGS.fields, *[T.StructField(c, T.StringType()) for c in ("x", "n", "number", "vec_hash")]])
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in data], schema)
    result = compare(W.whitening_report(df), data)
    assert result[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)], [(1, [0.5, 0.25], 1)], [(1, [0.5, 0.25], 1)] * 9])
def test_nothing_to_whiten(spark, rows):
    assert W.whitening_report(spark.createDataFrame(rows, EMBEDDINGS)).count() == 0


def test_components_stop_at_the_rank(spark):
    flat = [(i, [float(i % 7), float(i % 5), float(i % 7) + float(i % 5), 1.0], 1) for i in range(70)]
    compare(W.whitening_report(spark.createDataFrame(flat, EMBEDDINGS)), flat)


def scatter(x):
    off = x - x.mean(axis=0)
    return off.T @ off


@pytest.mark.parametrize("d,n,kind", [(1, 9, "normal"), (12, 90, "normal"), (30, 200, "whole"), (30, 12, "whole"),
                                      (8, 50, "flat"), (4, 40, "equal"), (6, 80, "wide"), (16, 64, "axes")])
def test_spectra_of_updates_and_merges(d, n, kind):
    rng = np.random.default_rng(d * n)
    x = rng.normal(size=(n, d))
    if kind == "whole":
        x = np.floor(8 * x)
    elif kind == "flat":
        x = np.floor(rng.normal(size=(n, 2)) * 8) @ np.floor(rng.normal(size=(2, d)) * 4)
    elif kind == "equal":
        x = np.ones((n, d)) * 3
    elif kind == "wide":
        x = np.floor(x * 10.0 ** np.arange(d))
    elif kind == "axes":  # equal eigenvalues throughout
        x = np.concatenate([np.eye(d), -np.eye(d)] * (n // (2 * d)))
    cut = n // 3
    whole, one, two = Spectrum(d), Spectrum(d), Spectrum(d)
    for i, row in enumerate(x):
        whole.add(row)
        (one if i < cut else two).add(row)
    one.merge(two)
    exact = scatter(x)
    size = max(np.abs(exact).max(), 1e-300)
    for s in (whole, one):
        assert s.n == n and np.allclose(s.mean, x.mean(axis=0))
        assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-12
        assert np.abs((s.vectors * s.values) @ s.vectors.T - exact).max() <= 1e-12 * size
        assert (np.diff(s.values) >= 0).all()


def test_update_deflates_equal_and_untouched_values():
    values, vectors = np.array([1.0, 1.0, 1.0, 2.0, 5.0]), np.eye(5)
    u = np.array([1.0, 2.0, 2.0, 0.0, 1.0])
    d, q = W.rank_one(values, vectors, u, 0.5)
    assert np.allclose((q * d) @ q.T, np.diag(values) + 0.5 * np.outer(u, u), atol=1e-14)
    assert (np.abs(d - 1.0) < 1e-14).sum() == 2 and (np.abs(d - 2.0) < 1e-14).sum() == 1
    same = W.rank_one(values, vectors, np.zeros(5), 1.0)
    assert np.array_equal(same[0], values)


def test_basis_before_the_refinement_is_nearly_right(spark):
    """The incremental part does the work: its basis alone makes the covariance diagonal to many digits."""
    data = vectors(400, 10, 6)
    rows = W.as_integers(spark.createDataFrame(data, EMBEDDINGS), WhiteningOptions())
    fit = W.fit_list(rows, WhiteningOptions(rows=50))
    found = W._combined(W._spectra(fit, 10, 1_000_000), 3)
    x = np.array([r.x for r in fit.collect()], float)
    turned = found.vectors.T @ scatter(x) @ found.vectors
    off = turned - np.diag(np.diag(turned))
    assert found.n == len(x) and np.abs(off).max() < 1e-11 * turned.max()
    assert np.allclose(np.diag(turned), found.values, rtol=1e-10)
