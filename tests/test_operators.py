"""Property tests for splits, encoders, imputers, quantiles, solvers and blends."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabcast.operators import encode, ensemble, impute, knn, solve, split


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 600
    pdf = pd.DataFrame(
        {
            "k": np.arange(n, dtype=np.int64),
            "cat": rng.choice(["a", "b", "c", "d"], size=n, p=[0.6, 0.2, 0.15, 0.05]),
            "x1": rng.normal(size=n),
            "x2": rng.normal(size=n),
        }
    )
    pdf["y"] = 2.0 + 3.0 * pdf.x1 - 1.5 * pdf.x2 + rng.normal(scale=0.1, size=n)
    return spark.createDataFrame(pdf)


def test_holdout_disjoint_and_stable(frame):
    tr, va = split.holdout(frame, "k", 0.2)
    a = {r.k for r in tr.collect()}
    b = {r.k for r in va.collect()}
    assert not (a & b) and len(a | b) == 600
    tr2, va2 = split.holdout(frame.repartition(7), "k", 0.2)
    assert {r.k for r in va2.collect()} == b
    assert 0.1 < len(b) / 600 < 0.3


def test_every_key_in_one_fold(frame):
    f = split.kfold(frame, "k", 5)
    counts = f.groupBy("k").agg(F.countDistinct("fold").alias("n")).filter("n != 1").count()
    assert counts == 0
    assert set(r.fold for r in f.select("fold").distinct().collect()) == set(range(5))


def test_contiguous_folds_match_ntile(frame):
    got = split.kfold_contiguous(frame, "k", 5).toPandas().sort_values("k")
    n = 600
    expect = np.concatenate([np.full(n // 5, i) for i in range(5)])
    assert (got.fold.to_numpy() == expect).all()


def test_label_dictionary_roundtrip(frame):
    enc, dictionary = encode.label_encode(frame, frame, ["cat"])
    d = {r.code: r.value for r in dictionary.collect()}
    assert d == {0: "a", 1: "b", 2: "c", 3: "d"}
    back = enc.select("k", "cat").toPandas().set_index("k").cat.map(d)
    assert (back.sort_index() == frame.toPandas().set_index("k").cat.sort_index()).all()


def test_oof_encoding_ignores_own_label(spark, frame):
    base = split.kfold(frame, "k", 5)
    enc1 = encode.target_encode_oof(base, ["cat"], "y", "fold", 2.0, 5, suffix="_te")
    changed = base.withColumn("y", F.when(F.col("k") == 3, F.lit(1e6)).otherwise(F.col("y")))
    enc2 = encode.target_encode_oof(changed, ["cat"], "y", "fold", 2.0, 5, suffix="_te")
    r1 = enc1.filter("k = 3").first().cat_te
    r2 = enc2.filter("k = 3").first().cat_te
    assert math.isclose(r1, r2, rel_tol=1e-12)


def test_oof_encoding_matches_refit_per_fold(frame):
    base = split.kfold(frame, "k", 5)
    got = encode.target_encode_oof(base, ["cat"], "y", "fold", 1.5, 10, suffix="_te").toPandas().set_index("k")
    pdf = base.toPandas()
    for f in range(5):
        fit = pdf[pdf.fold != f]
        prior = fit.y.mean()
        st = fit.groupby("cat").y.agg(["count", "mean"])
        lam = 1 / (1 + np.exp(-(st["count"] - 10) / 1.5))
        encd = prior * (1 - lam) + st["mean"] * lam
        rows = pdf[pdf.fold == f]
        exp = rows.cat.map(encd).fillna(prior)
        assert np.allclose(got.loc[rows.k, "cat_te"].to_numpy(), exp.to_numpy(), rtol=1e-10)


def test_ordered_target_stat_bruteforce(frame):
    out = encode.ordered_target_stat(frame, "cat", "y", "k", seed=42, bucket_digits=1, out="ots").toPandas()
    pdf = frame.toPandas()
    import hashlib

    pdf["h"] = [hashlib.md5(f"{k}42".encode()).hexdigest() for k in pdf.k]
    pdf = pdf.sort_values(["cat", "h", "k"])
    pdf["n_before"] = pdf.groupby("cat").cumcount()
    pdf["s_before"] = pdf.groupby("cat").y.cumsum() - pdf.y
    prior = pdf.y.mean()
    pdf["exp"] = (pdf.s_before + prior) / (pdf.n_before + 1)
    m = out.set_index("k").join(pdf.set_index("k")[["n_before", "exp"]])
    assert (m.ots_n == m.n_before).all()
    assert np.allclose(m.ots, m.exp, rtol=1e-9)


def test_multi_column_ots_equals_single(frame):
    two = frame.withColumn("cat2", F.when(F.col("k") % 3 == 0, F.lit(None)).otherwise(F.col("cat")))
    many = encode.ordered_target_stats(two, ["cat", "cat2"], "y", "k", bucket_digits=1).toPandas().set_index("k")
    for c in ("cat", "cat2"):
        one = encode.ordered_target_stat(two, c, "y", "k", bucket_digits=2, out="o").toPandas().set_index("k")
        assert np.allclose(many[f"{c}_ots"].sort_index(), one["o"].sort_index(), rtol=1e-12)


def test_exact_quantiles_sketch_path(spark):
    rng = np.random.default_rng(3)
    vals = rng.lognormal(size=5001)
    df = spark.createDataFrame(pd.DataFrame({"v": vals, "w": rng.normal(size=5001)}))
    for q in (0.25, 0.5, 0.9):
        got = impute.exact_quantiles(df, ["v", "w"], q, accuracy=500)
        assert math.isclose(got["v"], float(np.quantile(vals, q)), rel_tol=1e-12)


def test_exact_quantiles_of_one_column_share_a_sketch(spark, monkeypatch):
    rng = np.random.default_rng(4)
    ties, vals = rng.integers(0, 4, 3000).astype(float), rng.normal(size=3000)
    df = spark.createDataFrame(pd.DataFrame({"t": ties, "v": vals}))
    calls, sketch = [], F.percentile_approx
    monkeypatch.setattr(impute.F, "percentile_approx", lambda *a: calls.append(a) or sketch(*a))
    qs = (0.25, 0.5, 0.75)
    assert impute.exact_quantiles(df, ["t"], qs, accuracy=500) == {q: {"t": float(np.quantile(ties, q))} for q in qs}
    assert len(calls) == 1
    got = impute.exact_quantiles(df, ["t", "v"], qs, accuracy=500)
    assert all(math.isclose(got[q]["v"], float(np.quantile(vals, q)), rel_tol=1e-12) for q in qs)


def test_most_frequent_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "c string")
    r = impute.most_frequent(df, ["c"]).first()
    assert (r.value, r.n) == ("a", 2)


def test_iterative_impute_keeps_observed(spark, frame):
    holes = frame.withColumn("x1", F.when(F.col("k") % 9 == 0, F.lit(None)).otherwise(F.col("x1")))
    out = impute.iterative_impute(holes, ["x1", "x2", "y"], max_iter=5).toPandas().set_index("k").sort_index()
    src = frame.toPandas().set_index("k").sort_index()
    obs = src.index % 9 != 0
    assert out.x1.notna().all()
    assert np.allclose(out.x1[obs], src.x1[obs])
    # x1 is recoverable from y and x2, so the imputed cells are close to the truth
    assert np.abs(out.x1[~obs] - src.x1[~obs]).max() < 0.2


def test_ridge_gram_vs_closed_form(frame):
    G, xy, yy, n = solve.gram(frame, ["x1", "x2"], "y")
    pdf = frame.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    w = solve.ridge_from_gram(G, xy, 5.0)
    P = np.eye(3) * 5.0
    P[0, 0] = 0
    assert np.allclose(w, np.linalg.solve(X.T @ X + P, X.T @ pdf.y.to_numpy()))
    assert math.isclose(solve.rss_from_gram(G, xy, yy, w), float(((pdf.y - X @ w) ** 2).sum()), rel_tol=1e-8)


def test_gd_equals_per_row_gd(frame):
    pdf = frame.toPandas()
    X, y = pdf[["x1", "x2"]].to_numpy(), pdf.y.to_numpy()
    G, xy, yy, n = solve.gram(frame, ["x1", "x2"], "y")
    w, hist = solve.ridge_gradient_descent(G, xy, yy, n, lr=0.01, steps=200, alpha=0.5)
    wt, b = np.zeros(2), 0.0
    for _ in range(200):
        p = X @ wt + b
        dw = (-2 / n) * X.T @ (y - p) + 2 * 0.5 * wt
        db = (-2 / n) * np.sum(y - p)
        wt, b = wt - 0.01 * dw, b - 0.01 * db
    assert np.allclose(w, [b, *wt], rtol=1e-9)
    assert hist[0] == (0, "train", pytest.approx(float(np.sqrt(np.mean(y ** 2)))))


def test_nnls_matches_bruteforce():
    rng = np.random.default_rng(1)
    A = rng.normal(size=(40, 3))
    b = A @ np.array([0.5, -0.2, 0.8]) + rng.normal(scale=0.01, size=40)
    x = solve.nnls(A, b)
    best = None
    import itertools

    for mask in itertools.product([0, 1], repeat=3):
        idx = [i for i in range(3) if mask[i]]
        z = np.zeros(3)
        if idx:
            z[idx] = np.linalg.lstsq(A[:, idx], b, rcond=None)[0]
        if (z >= 0).all():
            r = np.sum((A @ z - b) ** 2)
            if best is None or r < best[0]:
                best = (r, z)
    assert np.allclose(x, best[1], atol=1e-8)


def test_weight_search_rmse_equals_direct(spark, frame):
    base = split.kfold(frame, "k", 5)
    preds = ensemble.baseline_oof(base, "k", "y", "fold", "cat", "x1")
    scored, best = ensemble.weight_search(ensemble.baseline_oof_wide(base, "k", "y", "fold", "cat", "x1"), ["group_mean", "line", "mean"], n_trials=20)
    row = scored.filter("trial = 7").first()
    wide = preds.groupBy("k").pivot("model", ["group_mean", "line", "mean"]).agg(F.first("pred")).join(
        preds.groupBy("k").agg(F.first("y").alias("y")), "k").toPandas()
    blend = wide.group_mean * row.group_mean + wide.line * row.line + wide["mean"] * row["mean"]
    assert math.isclose(row.rmse, float(np.sqrt(np.mean((wide.y - blend) ** 2))), rel_tol=1e-9)
    assert math.isclose(row.group_mean + row.line + row["mean"], 1.0, rel_tol=1e-12)
    b = best.first()
    assert b.rmse == pytest.approx(min(r.rmse for r in scored.collect()))


def test_no_exchange_between_wide_predictions_and_the_gram(spark, frame):
    """Neither the error Gram nor a blend shuffles rows; joins are broadcasts of per-fold and per-category rows."""
    wide = ensemble.baseline_oof_wide(split.kfold(frame, "k", 5), "k", "y", "fold", "cat", "x1")
    models = ["group_mean", "line", "mean"]
    weights = spark.createDataFrame([("line", 0.7), ("mean", 0.3)], "model string, weight double")
    errors = wide.select(*[(F.col(m) - F.col("y")).alias(m) for m in models])
    for df in (errors, ensemble.blend_wide(wide, weights, models, ("k",))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = [line for line in plan.split("\n") if " Exchange " in line and "k#" in line]
        assert not rows and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_wide_blends_equal_long_ones(spark, frame):
    base = split.kfold(frame, "k", 5)
    models = ("mean", "group_mean", "line")
    wide, long = (f(base, "k", "y", "fold", "cat", "x1") for f in (ensemble.baseline_oof_wide, ensemble.baseline_oof))
    rows = [("s", "mean", 0.2), ("s", "line", 0.8), ("t", "line", 1.0), ("t", "mean", 0.0)]
    weights = spark.createDataFrame(rows, "w string, model string, weight double")
    got = ensemble.blend_wide(wide, weights, models, ("k",), set_col="w").toPandas().sort_values(["w", "k"])
    want = ensemble.blend(long, weights, "k", set_col="w").toPandas().sort_values(["w", "k"])
    assert np.allclose(got.blend_log, want.blend_log) and (got.k.to_numpy() == want.k.to_numpy()).all()
    mean = wide.select("k", ensemble.average_wide(models).alias("p")).toPandas().sort_values("k")
    assert np.allclose(mean.p, ensemble.simple_average(long, "k").toPandas().sort_values("k").pred)
    again = ensemble.to_wide(long, "k", models).toPandas().sort_values("k")
    assert np.allclose(again[list(models)], wide.toPandas().sort_values("k")[list(models)])


def test_simplex_weights_are_optimal():
    import itertools

    rng = np.random.default_rng(8)
    for trial in range(60):
        m = 2 + trial % 5
        e = rng.normal(size=(30, m)) * rng.uniform(0.2, 3, m) + rng.normal(size=(30, 1))
        if trial % 7 == 0:
            e[:, -1] = e[:, 0]  # two models alike
        E = e.T @ e
        w = solve.simplex_weights(E)
        assert (w >= 0).all() and np.isclose(w.sum(), 1)
        best = np.inf
        for used in itertools.chain.from_iterable(itertools.combinations(range(m), k) for k in range(1, m + 1)):
            k = len(used)
            kkt = np.block([[E[np.ix_(used, used)], np.ones((k, 1))], [np.ones((1, k)), np.zeros((1, 1))]])
            z = np.linalg.lstsq(kkt, np.append(np.zeros(k), 1.0), rcond=None)[0][:k]
            if (z >= -1e-12).all():
                best = min(best, float(z @ E[np.ix_(used, used)] @ z))
        assert w @ E @ w <= best * (1 + 1e-9)


def test_best_weights_are_not_beaten_by_any_trial(spark, frame):
    wide = ensemble.baseline_oof_wide(split.kfold(frame, "k", 5), "k", "y", "fold", "cat", "x1")
    rows = ensemble.best_weights(wide, ["group_mean", "line", "mean"], n_trials=200).collect()
    assert math.isclose(sum(r.weight for r in rows), 1.0, rel_tol=1e-9) and rows[0].rmse <= rows[0].best_trial_rmse + 1e-12


def test_line_model_beats_mean(spark, frame):
    base = split.kfold(frame, "k", 5)
    preds = ensemble.baseline_oof(base, "k", "y", "fold", "cat", "x1").toPandas()
    rmse = preds.assign(e=(preds.y - preds.pred) ** 2).groupby("model").e.mean() ** 0.5
    assert rmse["line"] < rmse["mean"]


def test_normalise_weights(spark):
    w = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "model string, weight double")
    got = {r.model: r.weight for r in ensemble.normalise_weights(w).collect()}
    assert got == {"a": 0.25, "b": 0.75}


def test_knn_matches_numpy(spark):
    rng = np.random.default_rng(5)
    T = rng.normal(size=(200, 4))
    Q = rng.normal(size=(30, 4))
    Q[0] = T[5]  # an exact match takes all the weight
    ty = rng.normal(size=200)
    tr = spark.createDataFrame([(int(i), [float(v) for v in T[i]], float(ty[i])) for i in range(200)],
                               "key long, vec array<double>, y double")
    qu = spark.createDataFrame([(int(1000 + i), [float(v) for v in Q[i]]) for i in range(30)],
                               "key long, vec array<double>")
    got = knn.knn_regress(tr, qu, k=10, block_rows=64).toPandas().set_index("key")  # forces 4×1 cells
    for i in range(30):
        d = np.sqrt(((T - Q[i]) ** 2).sum(axis=1))
        nn = np.lexsort((np.arange(200), d))[:10]
        if d[nn[0]] == 0:
            exp = ty[nn][d[nn] == 0].mean()
        else:
            w = 1 / d[nn]
            exp = (w * ty[nn]).sum() / w.sum()
        assert math.isclose(got.loc[1000 + i, "pred"], exp, rel_tol=1e-9)


@pytest.mark.parametrize("shape", ["clusters", "isotropic", "ties"])
def test_knn_cells_are_exact_and_few_where_there_is_structure(spark, shape):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 3)) * 40
    T = {"clusters": centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 3)), "isotropic": rng.normal(size=(600, 6)), "ties": rng.integers(0, 3, (600, 2)).astype(float)}[shape]
    Q = T[rng.integers(0, 600, 80)] + (rng.normal(size=(80, T.shape[1])) * 0.1 if shape != "ties" else 0.0)
    tr = spark.createDataFrame([(i, [float(v) for v in t], float(i % 7)) for i, t in enumerate(T)], "key long, vec array<double>, y double")
    qu = spark.createDataFrame([(1000 + i, [float(v) for v in q]) for i, q in enumerate(Q)], "key long, vec array<double>")
    got = {}
    for r in knn.knn_neighbours(tr, qu, k=5, block_rows=40).collect():
        got.setdefault(r.qkey, []).append((r["rank"], r.tkey, r.dist))
    for i, q in enumerate(Q):
        d = np.sqrt(((T - q) ** 2).sum(axis=1))
        want = np.lexsort((np.arange(600), d))[:5]
        rows = sorted(got[1000 + i])
        assert [t for _, t, _ in rows] == want.tolist() and np.allclose([x for *_, x in rows], d[want])
    _, visited, cells = knn.knn_visits(tr, qu, k=5, block_rows=40)
    share = visited.agg(F.avg("visited")).first()[0] / len(cells.pivots)
    if shape == "clusters":
        assert share < 0.35
    few = knn.knn_neighbours(tr.limit(3), qu, k=5).groupBy("qkey").count().collect()
    assert {r["count"] for r in few} == {3} and len(few) == 80
    assert knn.knn_neighbours(tr.limit(0), qu, k=5).count() == 0


def test_partial_neighbours_keep_ties_and_drop_what_lies_beyond_the_bound():
    import numpy as np
    import pandas as pd

    from tabcast.operators import knn

    r = np.random.default_rng(3)
    t = np.repeat(r.normal(size=(60, 5)) * 1e3 + 1e6, 4, axis=0)
    q = np.concatenate([t[::40], r.normal(size=(20, 5)) * 1e3 + 1e6])
    train = pd.DataFrame({"key": r.permutation(len(t)), "vec": list(t), "y": r.normal(size=len(t))})
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(axis=2))
    bound = np.where(np.arange(len(q)) % 2 == 0, np.nan, np.sort(d, axis=1)[:, 3])
    got = knn._partial_topk(7)(train, pd.DataFrame({"key": np.arange(len(q)), "vec": list(q), "y": bound}))
    for i in range(len(q)):
        order = np.lexsort((train["key"], d[i]))[:7]
        want = [int(train["key"][j]) for j in order if not d[i, j] > bound[i]]
        assert got[got["qkey"] == i]["tkey"].tolist() == want
    assert len(got) < 7 * len(q)


def test_knn_of_long_vectors_takes_little_memory():
    import tracemalloc

    r = np.random.default_rng(3)
    x, pivots = r.normal(size=(3000, 200)), r.normal(size=(64, 200))
    train = pd.DataFrame({"key": np.arange(3000), "vec": list(x), "y": x[:, 0]})
    query = pd.DataFrame({"key": np.arange(400), "vec": list(x[:400] + 0.01), "y": np.full(400, np.nan)})
    tracemalloc.start()
    try:
        d = knn._distances(x, pivots)
        distances = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        found = knn._partial_topk(100)(train, query)
        nearest = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 3000 x 64 x 200 differences at once would be 307 MB, those of 400 x 100 pairs 64 MB each.
    assert distances < 20e6 and nearest < 110e6
    assert np.allclose(d[:5], np.sqrt(((x[:5, None] - pivots) ** 2).sum(axis=2)))
    assert len(found) == 40_000 and (found.groupby("qkey")["dist"].min().to_numpy() < 0.2).all()


def test_pca_variance_holds_nothing(spark):
    rows = spark.createDataFrame([(float(i % 7), float(i % 5) if i % 3 else None, float(i * i % 11)) for i in range(200)], "a double, b double, c double")
    persisted = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = persisted()
    filled, _ = impute.median_fill(rows, rows, ["a", "b", "c"], again=True)
    k, table, _, centred = encode.pca_variance(filled, ["a", "b", "c"])
    assert persisted() == before and centred.count() == 200
    x = filled.toPandas().to_numpy()
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose([r["explained"] for r in table.orderBy("component").collect()], want / want.sum()) and k == 3
    assert impute.exact_quantiles(rows, ["a", "b", "c"], 0.5, again=True) == impute.exact_quantiles(rows, ["a", "b", "c"], 0.5)
