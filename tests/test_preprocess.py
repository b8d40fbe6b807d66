"""The nine-step preprocessing plan: shapes, no missing features, observed cells kept, codes in range."""

import math

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_preprocess_properties(spark):
    from tabcast.plans.catalogue import KEY, TARGET, labelled, unlabelled
    from tabcast.plans.preprocess import preprocess

    tr_raw, te_raw = labelled(spark, SF_SMALL), unlabelled(spark, SF_SMALL)
    p = preprocess(tr_raw, te_raw, KEY, TARGET, fit_on="union", impute=True, max_iter=3)
    train, test = p.train.cache(), p.test.cache()
    assert train.count() == tr_raw.count() and test.count() == te_raw.count()
    assert TARGET not in test.columns and f"{TARGET}_Log" in train.columns
    feats = p.categorical + p.numeric
    # no missing feature anywhere after fill + encode + chained-equation imputation
    nulls = train.unionByName(test, allowMissingColumns=True).agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in feats]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls
    # label codes are 0..n-1 and Rural_Hospital is −1/0/1
    codes = p.dictionary.groupBy("column").agg(F.max("code").alias("m"), F.count("*").alias("n")).collect()
    assert all(r.m == r.n - 1 for r in codes)
    assert {r.Rural_Hospital for r in train.select("Rural_Hospital").distinct().collect()} <= {-1, 0, 1}
    # observed numeric cells are unchanged by imputation
    raw = tr_raw.select(KEY, F.col("Equipment_Value").alias("raw_v"))
    j = train.select(KEY, "Equipment_Value").join(raw, KEY).filter(F.col("raw_v").isNotNull())
    assert j.filter(F.abs(F.col("Equipment_Value") - F.col("raw_v")) > 1e-9).count() == 0
    # the log target inverts to the raw target
    shift = p.shift.first()[0]
    r = train.select(TARGET, f"{TARGET}_Log").first()
    assert math.isclose(math.expm1(r[1]) - shift, r[0], rel_tol=1e-9, abs_tol=1e-6)


def test_exact_quantiles_with_ties(spark):
    """Columns that nearly all rows hold one value of, and others, against numpy; the sketch is coarse on purpose."""
    import numpy as np

    from tabcast.operators.impute import exact_quantiles

    r = np.random.default_rng(0)
    n = 20_000
    cols = {"zeros": np.where(r.random(n) < 0.9, 0.0, r.random(n)), "normal": r.normal(size=n), "coin": r.integers(0, 2, n).astype(float)}
    df = spark.createDataFrame([tuple(map(float, x)) for x in zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    df = df.withColumn("none", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("double"))
    qs = (0.0, 0.05, 0.25, 0.5, 0.9, 0.901, 1.0)
    got = exact_quantiles(df, [*cols, "none"], qs, accuracy=50)
    for q in qs:
        assert got[q]["none"] is None
        for c, v in cols.items():
            assert abs(got[q][c] - np.quantile(v, q)) < 1e-12
    assert exact_quantiles(df, ["zeros"], 0.5) == {"zeros": 0.0}


def test_iterative_impute_equals_least_squares_on_mixed_scales(spark):
    import numpy as np

    from tabcast.operators.impute import iterative_impute

    r = np.random.default_rng(1)
    big, small = r.normal(size=400) * 1e5 + 2e6, r.normal(size=400)
    y = 3e-5 * big - 2 * small + 0.1 * r.normal(size=400) + 7
    missing = r.random(400) < 0.2
    rows = [(i, None if m else float(a), float(b), float(c)) for i, (m, a, b, c) in enumerate(zip(missing, y, big, small))]
    out = iterative_impute(spark.createDataFrame(rows, "k int, y double, big double, small double"), ["y", "big", "small"], max_iter=1)
    got = np.array([x["y"] for x in out.orderBy("k").collect()])
    X = np.column_stack([np.ones(400), big, small])
    want = X @ np.linalg.lstsq(X[~missing], y[~missing], rcond=None)[0]
    assert np.allclose(got[missing], want[missing], rtol=1e-6) and np.allclose(got[~missing], y[~missing])
