"""Shifted Cholesky QR against eigenvectors of the covariance in numpy, exact parts in Python integers."""

import math
import random

import numpy as np
import pytest

from riskloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows):
    kept = [(i, [math.floor(64 * float(np.float32(x))) + 1_000_000 for x in v]) for i, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    a = np.array([[(n * x - s) / n for x, s in zip(v, sums, strict=True)] for v in fit])
    e, ways = np.linalg.eigh(a.T @ a / n)
    return kept, n, sums, a, e[::-1], ways[:, ::-1]


def check(got, rows, loose=1e-6):
    kept, n, sums, a, e, ways = brute(rows)
    k = min(16, int((e > 1e-12 * e[0]).sum())) if len(e) and e[0] > 0 else 0
    assert len(got) == k * len(kept)
    by_row = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        by_row.setdefault((r.vec_id, r.component), []).append(r)
    for c in range(1, k + 1):
        mine = [by_row[i, c][0] for i, _ in kept]
        want = np.array([[x - s / n for x, s in zip(v, sums, strict=True)] for _, v in kept]) @ ways[:, c - 1] / np.sqrt(e[c - 1])
        found = np.array([r.whitened for r in mine])
        gap = min(abs(e[c - 1] - e[j]) for j in (c - 2, c) if 0 <= j < len(e)) if len(e) > 1 else e[0]
        if gap > 1e-3 * e[c - 1]:  # else the direction is free
            assert min(np.abs(found - want).max(), np.abs(found + want).max()) <= loose * max(1, np.abs(want).max())
        for (_, v), r in zip(kept, mine, strict=True):
            assert r.deviation == sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)) == int(r.deviation_exact)
            assert r.explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-4)


def test_random_vectors_with_copies(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(150, 20)) * np.linspace(5, 0.2, 20)
    rows = [(i, v) for i, v in enumerate(base)] + [(500 + i, base[0]) for i in range(60)] + [(7, base[7]), (None, base[8])]
    bad = [(900, None), (901, [float("nan")] * 20), (902, [1.0] * 19 + [None]), (903, [float("inf")] + [0.0] * 19), (904, [])]
    df = table(spark, rows + bad).repartition(5)
    check(whitening.whitened(df).collect(), rows)


@pytest.mark.parametrize("kind", ["constant", "collinear", "few", "scales", "offset"])
def test_badly_conditioned_vectors(spark, kind):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(80, 12))
    if kind == "constant":
        x[:, 4] = 3.0
    if kind == "collinear":
        x = np.floor(64 * x) / 64
        x[:, 5] = 2 * x[:, 1] - x[:, 0]
    if kind == "few":
        x = x[:5]
    if kind == "scales":
        x *= 10.0 ** np.linspace(4, -1, 12)
    if kind == "offset":
        x += 2.0**17
    rows = list(enumerate(x.astype(np.float32)))
    check(whitening.whitened(table(spark, rows)).collect(), rows)


def test_passes_orthogonalise(spark):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(300, 8)) * 10.0 ** np.linspace(6, 0, 8)
    each = whitening.stored(whitening.integer_vectors(table(spark, list(enumerate(x)))), "vectors")
    middle = whitening.centre(each)
    w, passes = whitening.triangle(each, middle)
    u = np.array([whitening._unpack(r.x) for r in each.collect()])
    a = middle.rows(u)
    assert passes >= 2 and np.allclose(np.linalg.svd(w)[1], np.linalg.svd(a)[1], rtol=1e-10)
    q = whitening.solve_rows(a, np.linalg.qr(a)[1])
    assert np.allclose(q.T @ q, np.eye(8), atol=1e-9)


def test_without_variance_sizes_and_columns(spark, nothing):
    one = table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.whitened(one).collect() == []
    assert whitening.whitened(table(spark, [(1, None)])).collect() == []
    rnd = random.Random(1)
    two = [(i, [rnd.random() * 9 for _ in range(2 + i % 2)]) for i in range(40)]
    got = whitening.whitened(table(spark, two).selectExpr("*", "1 as n", "2 as x", "3 as size", "4 as component")).collect()
    check([r for r in got if r.vec_id % 2 == 0], two[::2])
    check([r for r in got if r.vec_id % 2], two[1::2])


def test_large_finite_entries(spark):
    rows = [(i, [float(i), 1e30 if i == 3 else -(2.0**40), 2.0**31 + i * 512]) for i in range(9)]
    got = whitening.whitened(table(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(9)) and all(r.n == 9 for r in got)
    first = [r for r in got if r.component == 1]
    assert np.mean([r.whitened for r in first]) == pytest.approx(0, abs=1e-9)
    assert np.mean([r.whitened**2 for r in first]) == pytest.approx(1)


def test_registered_query(spark):
    from tests.conftest import DATA

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    check(whitening.op11_embedding_whitening(spark, DATA).collect(), rows)
