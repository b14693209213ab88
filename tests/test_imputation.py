"""Imputation against direct computations on small matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import chained, nearest_fill


def frame(spark, x, n=8):
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)]
    names = [f"c{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names)).repartition(n), names


def collected(df, names):
    return np.array([[r[c] for c in names] for r in df.orderBy("id").collect()], dtype=float)


def holes(seed, n, whole=False, p=3):
    rng = np.random.default_rng(seed)
    x = np.empty((n, p))
    x[:, 0] = rng.normal(50, 10, n)
    x[:, 1] = 0.5 * x[:, 0] + rng.normal(0, 3, n)
    x[:, 2] = 2.0 * x[:, 0] - 0.7 * x[:, 1] + rng.normal(0, 5, n)
    if whole:
        x = np.round(x / 10)
    truth = x.copy()
    x[rng.random(x.shape) < 0.15] = np.nan
    return x, truth


def brute_knn(x, k):
    """Direct form: k nearest rows that know the value, ties to the smaller value."""
    out = x.copy()
    p = x.shape[1]
    for i, j in zip(*np.nonzero(np.isnan(x)), strict=True):
        found = []
        for other in range(len(x)):
            both = ~np.isnan(x[i]) & ~np.isnan(x[other])
            if other != i and not np.isnan(x[other, j]) and both.any():
                d = np.sqrt(p / both.sum() * np.sum((x[i, both] - x[other, both]) ** 2))
                found.append((d, x[other, j]))
        found = sorted(found)[:k]
        if not found:
            out[i, j] = np.nanmean(x[:, j])
            continue
        d, v = np.array(found).T
        w = (d == 0).astype(float) if (d == 0).any() else 1 / d
        out[i, j] = np.sum(w * v) / np.sum(w)
    return out


@pytest.mark.parametrize(("whole", "block"), [(False, 1024), (False, 5), (True, 5)])
def test_knn_equals_brute_force(spark, whole, block):
    x, _ = holes(3, 240, whole)
    x[5] = np.nan
    df, names = frame(spark, x)
    got = collected(nearest_fill.impute_knn(df, names, k=5, block=block), names)
    np.testing.assert_allclose(got, brute_knn(x, 5), rtol=1e-9)


def test_knn_with_a_hot_tuple(spark):
    """A third of the rows are copies of one tuple; they count as separate neighbours."""
    x = np.vstack([np.tile([1.0, 1.0, 7.0], (40, 1)), np.array([[1.0, 2.0, 3.0], [1.0, 1.0, np.nan], [np.nan, 2.0, 3.0]])])
    df, names = frame(spark, x)
    got = collected(nearest_fill.impute_knn(df, names, k=5), names)
    assert got[41, 2] == 7.0
    np.testing.assert_allclose(got, brute_knn(x, 5), rtol=1e-9)


def test_knn_without_gaps_or_donors(spark):
    x = np.array([[1.0, np.nan], [np.nan, 2.0], [3.0, np.nan]])
    df, names = frame(spark, x, 2)
    got = collected(nearest_fill.impute_knn(df, names), names)
    np.testing.assert_allclose(got, [[1, 2], [2, 2], [3, 2]])
    full, names = frame(spark, np.ones((3, 2)), 2)
    np.testing.assert_allclose(collected(nearest_fill.impute_knn(full, names), names), np.ones((3, 2)))


def rowwise_chained(x, rounds):
    """The same rounds on the rows themselves."""
    gap = np.isnan(x)
    z = np.where(gap, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        for j in sorted(np.flatnonzero(gap.any(0)), key=lambda j: (gap[:, j].sum(), j)):
            others = [c for c in range(x.shape[1]) if c != j]
            known = ~gap[:, j]
            a, b = z[known][:, others], z[known, j]
            am, bm = a.mean(0), b.mean()
            a, b = a - am, b - bm
            w = chained.evidence_ridge(a.T @ a, a.T @ b, b @ b, len(b))
            z[gap[:, j], j] = (z[gap[:, j]][:, others] - am) @ w + bm
    return z


def test_chained_equals_rowwise_rounds(spark):
    x, truth = holes(42, 200)
    x[7] = np.nan
    df, names = frame(spark, x)
    got = collected(chained.impute_iterative(df, names, max_rounds=6, tol=0.0), names)
    np.testing.assert_allclose(got, rowwise_chained(x, 6), rtol=1e-6)
    gap = np.isnan(x)
    gap[7] = False
    error = np.sqrt(np.mean((got[gap] - truth[gap]) ** 2))
    mean_error = np.sqrt(np.mean((np.broadcast_to(np.nanmean(x, axis=0), x.shape)[gap] - truth[gap]) ** 2))
    assert error < 0.75 * mean_error


def test_chained_does_not_depend_on_partitions(spark):
    x, _ = holes(1, 150)
    one, names = frame(spark, x, 1)
    many, _ = frame(spark, x, 8)
    a, b = (collected(chained.impute_iterative(d, names), names) for d in (one, many))
    np.testing.assert_allclose(a, b, rtol=1e-9)


def test_wide_tables_and_nan(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(160, 12))
    x[:, 6:] = x[:, :6] * 2 + rng.normal(scale=0.1, size=(160, 6))
    x[rng.random(x.shape) < 0.02] = np.nan
    df, names = frame(spark, x)
    mixed = df.withColumns({c: F.when(F.col(c).isNull() & (F.rand(3) < 0.5), F.lit(float("nan"))).otherwise(F.col(c)) for c in names})
    got = collected(chained.impute_iterative(mixed, names, max_rounds=4, tol=0.0), names)
    np.testing.assert_allclose(got, rowwise_chained(x, 4), rtol=1e-6)
    near = collected(nearest_fill.impute_knn(mixed, names[:8], k=3), names[:8])
    np.testing.assert_allclose(near, brute_knn(x[:, :8], 3), rtol=1e-9)


def test_chained_on_rows_equals_patterns(spark):
    """The rounds on stored rows, on pattern matrices and on a matrix in memory agree; an empty column and a full one are kept."""
    x, _ = holes(11, 300, p=5)
    x[:, 3] = x[:, 0] - x[:, 2] + np.random.default_rng(2).normal(size=300)
    x[:, 4] = x[:, 1] * 0.3
    x[np.random.default_rng(3).random(x.shape) < 0.1] = np.nan
    x[9] = np.nan
    df, names = frame(spark, x)
    wide = df.withColumn("none", F.lit(None).cast("double"))
    want = rowwise_chained(x, 3)
    for size in (1 << 26, 0):
        done = chained.impute_iterative(wide, [*names, "none"], max_rounds=3, tol=0.0, moment_bytes=size)
        assert done.columns == wide.columns and done.filter("none IS NOT NULL").count() == 0
        np.testing.assert_allclose(collected(chained.impute_iterative(df, names, max_rounds=3, tol=0.0, moment_bytes=size), names), want, rtol=1e-6)


def test_chained_wide_with_many_patterns(spark):
    """Eighty columns, a pattern of gaps of its own for nearly every row."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(2500, 6))
    x = base @ rng.normal(size=(6, 80)) + rng.normal(scale=0.2, size=(2500, 80))
    x[:, 68:][rng.random((2500, 12)) < 0.5] = np.nan
    df, names = frame(spark, x)
    assert len({tuple(r) for r in np.isnan(x)}) > 1800
    got = collected(chained.impute_iterative(df, names, max_rounds=1, tol=0.0), names)
    np.testing.assert_allclose(got, rowwise_chained(x, 1), rtol=1e-6)


def test_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(chained, "FAN", 2)
    x, _ = holes(4, 90)
    df, names = frame(spark, x, 13)
    moments = chained.pattern_moments(df, names, np.zeros(3))
    whole = sum(moments.values())
    z = np.c_[np.ones(90), np.nan_to_num(x)]
    np.testing.assert_allclose(whole, z.T @ z, rtol=1e-12)
    assert set(moments) == {sum(1 << i for i in range(3) if g[i]) for g in np.isnan(x)}


@pytest.mark.parametrize("parts", [(2048, 16_384, 1024), (9, 40, 4)])
def test_knn_of_wide_tables(spark, monkeypatch, parts):
    """Forty columns with random gaps; ties, copies, a row without any value."""
    for name, value in zip(("WIDE_RECEIVERS", "WIDE_DONORS", "PACK"), parts, strict=True):
        monkeypatch.setattr(nearest_fill, name, value)
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(150, 40)), 1)
    x[:20] = x[20]
    x[rng.random(x.shape) < 0.1] = np.nan
    x[33] = np.nan
    df, names = frame(spark, x)
    done = nearest_fill.impute_knn(df, names, k=4)
    assert done.columns == df.columns
    np.testing.assert_allclose(collected(done, names), brute_knn(x, 4), rtol=1e-9)


def test_knn_both_ways(spark, monkeypatch):
    """Cells per pattern and whole rows give the same values."""
    x, _ = holes(13, 200, p=4)
    x[:, 3] = np.random.default_rng(1).normal(size=200)
    df, names = frame(spark, x)
    cells = collected(nearest_fill.impute_knn(df, names), names)
    monkeypatch.setattr(nearest_fill, "MAX_TASKS", 0)
    np.testing.assert_allclose(collected(nearest_fill.impute_knn(df, names), names), cells, rtol=1e-12)
