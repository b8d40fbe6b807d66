"""Chained imputation by missing pattern: against the column-by-column path, on unseen patterns, and without leaks."""

import numpy as np
import pytest

from tabcast.operators import chained, impute

COLS = ["a", "b", "c", "d"]
SCHEMA = "k int, a double, b double, c double, d double, e string"


def _rows(n=600, seed=3, patterns=True):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4)) @ r.normal(size=(4, 4)) * [1, 1e4, 1e-3, 30] + [5, 2e6, 0, -7]
    holes = r.random((n, 4)) < [0.05, 0.2, 0.35, 0.0]
    return [(i, *[None if h and patterns else float(v) for v, h in zip(row, hole)], "kept") for i, (row, hole) in enumerate(zip(x, holes))]


def _matrix(df):
    return np.array([[r[c] if r[c] is not None else np.nan for c in COLS] for r in df.orderBy("k").collect()])


@pytest.mark.parametrize("rounds", [1, 3, 10])
def test_equals_the_path_by_passes(spark, rounds):
    df = spark.createDataFrame(_rows(), SCHEMA).repartition(5)
    got = impute.iterative_impute(df, COLS, max_iter=rounds, tol=1e-6)
    want = _matrix(impute.impute_by_passes(df, COLS, max_iter=rounds, tol=1e-6))
    assert got.columns == df.columns
    assert np.allclose(_matrix(got), want, rtol=1e-9, atol=0)


def test_stops_at_the_same_round(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    for tol in (1e-1, 1e-3, 1e-7):
        fitted = chained.fit_chained(df, COLS, max_iter=10, tol=tol)
        want = impute.impute_by_passes(df, COLS, max_iter=10, tol=tol)
        assert 1 <= fitted.rounds <= 10 and np.allclose(_matrix(fitted.transform(df)), _matrix(want), rtol=1e-9, atol=0)


def test_fit_on_train_sees_no_test_row_and_fills_unseen_patterns(spark):
    train = spark.createDataFrame(_rows(seed=1), SCHEMA)
    test = spark.createDataFrame([(1, None, None, None, 1.0, "x"), (2, 1.0, 2e6, 0.0, None, "x"), (3, 1.0, None, 0.0, 2.0, "x"), (4, float("nan"), 1e6, 0.0, 2.0, "x")], SCHEMA)
    fitted = chained.fit_chained(train, COLS)
    alone = _matrix(fitted.transform(test))
    assert np.isfinite(alone[[0, 2, 3]]).all()
    # d was never missing where it was fitted, so nothing predicts it.
    assert np.isnan(alone[1, 3])
    changed = spark.createDataFrame([(i, *[v and v * 1e3 for v in r[1:5]], "x") for i, r in enumerate(_rows(50, 9))], SCHEMA)
    both = impute.iterative_impute(test.unionByName(changed), COLS, fit_df=train).where("e = 'x' AND k < 5 AND (k > 0)")
    again = _matrix(impute.iterative_impute(test, COLS, fit_df=train))
    assert np.allclose(again, alone, equal_nan=True) and both.count() >= 4
    # The same rows imputed beside other rows that are far away: nothing changes.
    beside = {tuple(r[c] for c in COLS) for r in impute.iterative_impute(test.unionByName(changed), COLS, fit_df=train).collect()}
    assert {tuple(row) for row in again.tolist() if not np.isnan(row).any()} <= beside


def test_observed_cells_keep_every_bit_and_odd_tables(spark):
    rows = _rows(200)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["k"]: r for r in impute.iterative_impute(df, COLS).collect()}
    assert all(got[r[0]][c] == v for r in rows for c, v in zip(COLS, r[1:]) if v is not None)
    full = spark.createDataFrame(_rows(50, patterns=False), SCHEMA)
    assert impute.iterative_impute(full, COLS).collect() == full.collect()
    assert impute.iterative_impute(df.limit(0), COLS).collect() == []
    bare = df.selectExpr("k", "a", "b", "CAST(NULL AS double) AS c", "d", "e")
    out = impute.iterative_impute(bare, COLS).collect()
    assert all(r["c"] is None and r["b"] is not None for r in out)


def test_too_many_patterns_go_column_by_column(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA)
    want = _matrix(impute.iterative_impute(df, COLS))
    with pytest.raises(chained.TooManyPatterns):
        chained.fit_chained(df, COLS, max_patterns=2)
    monkeypatch.setattr(impute, "fit_chained", lambda *a, **k: chained.fit_chained(*a, **k, max_patterns=2))
    assert np.allclose(_matrix(impute.iterative_impute(df, COLS)), want, rtol=1e-9, atol=0)


def test_reading_passes_do_not_grow_with_columns_or_rounds(spark):
    """Two passes over the written columns, and the probe of a bounded number of rows."""
    jobs = []
    df = spark.createDataFrame(_rows(), SCHEMA)
    seen = chained.PatternGrams.of, chained._largest_moves
    try:
        chained.PatternGrams.of = classmethod(lambda cls, *a: (jobs.append("grams"), seen[0].__func__(cls, *a))[1])
        chained._largest_moves = lambda *a: (jobs.append("moves"), seen[1](*a))[1]
        chained.fit_chained(df, COLS, max_iter=10)
    finally:
        chained.PatternGrams.of, chained._largest_moves = seen
    assert jobs == ["grams", "moves"]
