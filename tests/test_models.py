"""Spark ML fits reproduce the reference's objectives under the parameter mapping."""

import os

import numpy as np
import pandas as pd
import pytest

from tabcast.operators import models


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 200
    X = rng.normal(size=(n, 4)) * np.array([1.0, 2.0, 0.5, 3.0])
    y = 1.0 + X @ np.array([0.8, -0.3, 0.0, 0.2]) + rng.normal(scale=0.5, size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c", "d"]).assign(y=y)
    df = models.assemble(spark.createDataFrame(pdf), ["a", "b", "c", "d"])
    return df, X, y


def _enet_cd(X, y, l1, l2, iters=20000):
    """Coordinate descent for (1/2n)‖y − Xw − b‖² + l1‖w‖₁ + (l2/2)‖w‖² (intercept unpenalised)."""
    n, d = X.shape
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.zeros(d)
    for _ in range(iters):
        w_old = w.copy()
        for j in range(d):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = Xc[:, j] @ Xc[:, j] / n + l2
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / z
        if np.max(np.abs(w - w_old)) < 1e-13:
            break
    return w, ym - xm @ w


def test_ols_and_ridge_match_normal_equations(data):
    df, X, y = data
    A = np.column_stack([np.ones(len(X)), X])
    ols = models.fit_linear(df, "y", models.LinearSpec("ols"))
    w = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose([ols.intercept, *ols.coefficients], w, atol=1e-7)
    alpha = 25.0
    ridge = models.fit_linear(df, "y", models.LinearSpec("ridge", alpha))
    P = np.eye(5) * alpha
    P[0, 0] = 0
    # ‖y − Xw − b‖² + α‖w‖², intercept unpenalised
    Xc, yc = X - X.mean(0), y - y.mean()
    wr = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(4), Xc.T @ yc)
    assert np.allclose(ridge.coefficients, wr, atol=1e-6)


@pytest.mark.parametrize("kind,alpha,l1", [("lasso", 0.05, 1.0), ("enet", 0.1, 0.5)])
def test_lasso_and_enet_match_coordinate_descent(data, kind, alpha, l1):
    df, X, y = data
    m = models.fit_linear(df, "y", models.LinearSpec(kind, alpha, l1), max_iter=500)
    w, b = _enet_cd(X, y, alpha * l1, alpha * (1 - l1))
    assert np.allclose(m.coefficients, w, atol=2e-3)
    assert abs(m.intercept - b) < 5e-3


def test_best_rounds_counts_not_indices():
    curve = [(1, "validation", 3.0), (2, "validation", 2.0), (3, "validation", 2.5), (4, "validation", 2.6)]
    assert models.best_rounds(curve, "validation") == 2
    assert models.best_rounds(curve, "validation", patience=1) == 2


def test_a_pipeline_indexes_all_categories_in_one_pass():
    from pyspark.ml.feature import StringIndexer

    from tabcast.operators import models

    stages = models.dtype_dispatch(["x"], ["a", "b", "c"]).getStages()
    assert [s.getInputCols() for s in stages if isinstance(s, StringIndexer)] == [["a", "b", "c"]]


def test_cut_lineage_computes_its_rows_once(spark):
    from pyspark.sql import functions as F

    from tabcast.session import cut_lineage

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def note(x):
        seen.add(1)
        return x

    out = cut_lineage(spark.range(50, numPartitions=2).select(note("id").alias("id")))
    assert out.count() == 50 and seen.value == 50


def test_written_rows_take_the_place_of_their_shuffle_files(spark):
    import time

    from tabcast.session import release, written

    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in files.getAllFiles().mkString(" ").split() if "shuffle_" in f and f.endswith(".data")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffles(), spark.conf.get(setting, None)
    df = written(spark.range(10_000).repartition(4, "id").groupBy("id").count(), "cleaned")
    for _ in range(50):  # by another thread
        if not (left := shuffles() - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(setting, None) == was
    assert df.count() == 10_000
    path = df._scratch.removeprefix("file:")
    assert os.path.exists(path)
    release(df, spark.range(1))
    assert not os.path.exists(path)
