"""Whitened embeddings against exact whole sums and a plain eigendecomposition."""

from collections import Counter

import numpy as np
import pytest

from tallyfield.llm import whitening

from .helpers import table
from .test_vectors import edge_vectors, frame

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, components=16):
    """{(vec_id, row number, component): (n, deviation, whitened, explained)} by whole numbers and numpy's eigh."""
    fine = [(i, v) for i, v in rows if v and None not in v and np.isfinite(np.asarray(v, dtype=float)).all() and max(map(abs, v)) < (1 << 62) // 64]
    if not fine:
        return []
    sizes = Counter(len(v) for _, v in fine)
    d = max(sizes, key=lambda s: (sizes[s], s))
    x = [(i, tuple(int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v)) for i, v in fine if len(v) == d]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(v[k] for v in fit) for k in range(d)]
    centred = lambda v: np.array([(n * c - s) / n for c, s in zip(v, sums)])
    m = np.stack([centred(v) for v in fit])
    values, axes = np.linalg.eigh(m.T @ m / n)
    values, axes = values[::-1], axes[:, ::-1]
    keep = [k for k in range(min(components, d)) if values[k] > values[0] * 1e-12 * d]
    out = []
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        for k in keep:
            out.append((i, k + 1, n, deviation if deviation < 1 << 63 else None, abs(float(centred(v) @ axes[:, k] / np.sqrt(values[k]))), float(values[k] / np.trace(m.T @ m / n))))
    return out


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4] if r[0] is None else 0)
    rows = sorted([(*r[:4], abs(r[4]), r[5]) for r in map(tuple, got)], key=key)
    for a, b in zip(rows, sorted(want, key=key)):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-6, abs=1e-7) and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in got)
    assert len({r["identity_error"] for r in got}) <= 1


def whitened(df, **kw):
    out = whitening.whiten(df, **kw)
    assert out.columns == COLUMNS
    return out.collect()


def test_table(spark):
    df = table(spark, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    compare(whitened(df), plain(rows))
    # copies change neither the fit list nor the components
    compare(whitened(df.union(df.where("vec_id % 3 = 0"))), plain(rows + [x for x in rows if x[0] % 3 == 0]))


def test_covariance_is_the_identity_over_the_fit_list(spark):
    got = whitened(table(spark, "embeddings"))
    ids = {r["vec_id"]: k for k, r in enumerate(got)}
    w = np.zeros((len({r["vec_id"] for r in got}), 16))
    place = {i: k for k, i in enumerate(sorted(ids))}
    for r in got:
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    w = np.unique(w, axis=0)
    assert len(w) == got[0]["n"]
    assert np.abs(w.T @ w / len(w) - np.eye(16)).max() < 1e-9


def test_fast_falling_spectrum_converges_inside_the_basis(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((400, 6)) * 40 @ rng.standard_normal((6, 48))
    rows = [(k, [float(x) for x in np.round(v)]) for k, v in enumerate(base)]
    widths = []
    real = whitening.product
    monkeypatch.setattr(whitening, "product", lambda f, c, r: (widths.append(r.shape[1]), real(f, c, r))[1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(whitened(df, components=4, oversample=8, passes=8, tolerance=1e-13, scale=1), plain([(i, [x / 64 for x in v]) for i, v in rows], 4))
    assert max(widths) == 12
    widths.clear()
    whitened(df, components=4, oversample=0, passes=1, scale=1)
    assert 48 in widths  # residuals failed, so the basis grew to all dimensions


def test_edges(spark):
    rows = edge_vectors()
    want = plain([(i, v) for i, v, _ in rows])
    assert {r[0] for r in want} >= {None, 9, 50} and not {r[0] for r in want} & {1, 2, 4, 5, 6, 100, -50}
    compare(whitened(frame(spark, rows).withColumnRenamed("v", "y")), want)


def test_large_entries_are_exact_or_null(spark):
    rows = [(k, [float(1 << 40) * k, float(k % 3), 2.0**52]) for k in range(9)]
    got = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = plain(rows)
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == sorted((r[0], r[3]) for r in want if r[1] == 1)
    assert None in {r["deviation"] for r in got}


def test_nothing_to_fit(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], schema)) == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], schema)) == []
