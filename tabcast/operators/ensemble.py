"""Out-of-fold predictions and blending.

Predictions stay wide where they can: one row per key, one column per model, so that averages, blends,
error Grams and weight searches are narrow passes without a shuffle. A long table ``(key, model,
pred[, y, fold])``, as stored predictions are, is aligned once by ``to_wide``. Weights are a table
``(model, weight)`` with one row per model, so every broadcast here is bounded by the number of
models (and weight sets), not by rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.functions.mathx import clamp_min
from tabcast.operators.joins import bounded_broadcast, one_row_broadcast
from tabcast.operators.solve import gram, nonneg_ridge, simplex_weights

# ---------------------------------------------------------------- deterministic OOF predictors


def baseline_oof_wide(df: DataFrame, key: str, target: str, fold: str, category: str, x: str, keep=()) -> DataFrame:
    """B1 for three closed-form models, all folds at once by total − fold statistics, one column each:

    * ``mean``      — mean target of the other folds;
    * ``group_mean``— mean target of the row's category in the other folds (else ``mean``);
    * ``line``      — least-squares line on ``x`` fitted on the other folds' rows that have ``x``
                      (rows without ``x`` get ``mean``).

    Returns ``(key, fold, y, mean, group_mean, line, keep…)``; no fold ever sees its own targets.
    """
    y = F.col(target).cast("double")
    xv = F.col(x).cast("double")
    has_x = xv.isNotNull() & y.isNotNull()
    fstats = df.groupBy(fold).agg(
        F.count(y).alias("nf"),
        F.sum(y).alias("sy"),
        F.count(F.when(has_x, 1)).alias("nx"),
        F.sum(F.when(has_x, y)).alias("syx"),
        F.sum(F.when(has_x, xv)).alias("sx"),
        F.sum(xv * y).alias("sxy"),
        F.sum(F.when(has_x, xv * xv)).alias("sxx"),
    )
    names = ("nf", "sy", "nx", "syx", "sx", "sxy", "sxx")
    tot = fstats.agg(*[F.sum(c).alias(f"t_{c}") for c in names])
    rest = fstats.crossJoin(one_row_broadcast(tot)).select(
        fold, *[(F.col(f"t_{c}") - F.col(c)).alias(f"r_{c}") for c in names]
    )
    n, sy, nx, syx, sx, sxy, sxx = (F.col(f"r_{c}") for c in names)
    slope = (nx * sxy - sx * syx) / (nx * sxx - sx * sx)
    per_fold = rest.select(
        fold,
        (sy / n).alias("__mean"),
        slope.alias("__slope"),
        ((syx - slope * sx) / nx).alias("__icpt"),
    )
    cat = F.col(category).cast("string")
    cstats = df.groupBy(cat.alias("__v"), F.col(fold)).agg(F.count(y).alias("__n"), F.sum(y).alias("__s"))
    ctot = cstats.groupBy("__v").agg(F.sum("__n").alias("__nt"), F.sum("__s").alias("__st"))
    crest = cstats.join(ctot, "__v").select(
        "__v", F.col(fold).alias("__f"), (F.col("__nt") - F.col("__n")).alias("__nr"),
        (F.col("__st") - F.col("__s")).alias("__sr"),
    )
    base = df.select(F.col(key), F.col(fold), cat.alias("__cat"), xv.alias("__x"), y.alias("y"), *keep)
    crest = bounded_broadcast(crest)  # categories × folds rows; a hot category never meets a shuffle join
    rows = base.join(F.broadcast(per_fold), fold).join(
        crest, (F.col("__cat") == F.col("__v")) & (F.col(fold) == F.col("__f")), "left"
    )
    group_mean = F.when(F.col("__nr") > 0, F.col("__sr") / F.col("__nr")).otherwise(F.col("__mean"))
    line = F.coalesce(F.col("__icpt") + F.col("__slope") * F.col("__x"), F.col("__mean"))
    return rows.select(key, fold, "y", F.col("__mean").alias("mean"), group_mean.alias("group_mean"), line.alias("line"), *keep)


def to_long(wide: DataFrame, models, keep) -> DataFrame:
    """``(keep…, model, pred)``, one row per model; narrow."""
    return wide.unpivot(list(keep), list(models), "model", "pred")


def to_wide(preds: DataFrame, key: str, models) -> DataFrame:
    """Long predictions with ``y`` as one row per key (one shuffle)."""
    return preds.groupBy(key).pivot("model", list(models)).agg(F.first("pred")).join(preds.groupBy(key).agg(F.first("y").alias("y")), key)


def baseline_oof(df: DataFrame, key: str, target: str, fold: str, category: str, x: str) -> DataFrame:
    """``baseline_oof_wide`` as a long table ``(key, fold, model, pred, y)``."""
    wide = baseline_oof_wide(df, key, target, fold, category, x)
    return to_long(wide, ("mean", "group_mean", "line"), (key, fold, "y")).select(key, fold, "y", "model", "pred")


# ---------------------------------------------------------------- OOF / hold-out with Spark ML models


def oof_predictions(folds, key: str, fold: str, fitters: dict, label: str = "y", parallelism: int = 2) -> DataFrame:
    """B1: for each (train, valid) pair of ``folds`` and model m, fit ``fitters[m](train)`` and score ``valid``.

    The pairs come ready made, so whatever is fitted on features (fills, encodings) can be fitted on
    each fold's training rows. ``fitters[m]`` returns a fitted Spark ML model (or pipeline) whose
    ``transform`` adds a ``prediction`` column. The fits, distributed Spark ML jobs, run
    ``parallelism`` at a time; the result is unioned long.
    """
    from concurrent.futures import ThreadPoolExecutor

    jobs = [(train, valid, name, fit) for train, valid in folds for name, fit in fitters.items()]
    with ThreadPoolExecutor(parallelism) as pool:
        fitted = list(pool.map(lambda j: j[3](j[0]), jobs))
    parts = [
        model.transform(valid).select(
            key, F.col(fold), F.lit(name).alias("model"), F.col("prediction").alias("pred"), F.col(label).cast("double").alias("y")
        )
        for model, (_, valid, name, _) in zip(fitted, jobs)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def holdout_predictions(train: DataFrame, valid: DataFrame, key: str, fitters: dict, label: str = "y") -> DataFrame:
    """B2: one split, every model fitted on ``train`` and scored on ``valid`` → long table."""
    parts = []
    for name, fit in fitters.items():
        model = fit(train)
        parts.append(
            model.transform(valid).select(
                key, F.lit(name).alias("model"), F.col("prediction").alias("pred"), F.col(label).cast("double").alias("y")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- blending


def simple_average(preds: DataFrame, key: str, keep=("y",)) -> DataFrame:
    """Mean over models per key (one shuffle on the key, partial aggregation map-side)."""
    return preds.groupBy(key).agg(F.avg("pred").alias("pred"), *[F.first(c).alias(c) for c in keep])


def normalise_weights(weights: DataFrame, tol: float = 1e-9) -> DataFrame:
    """Divide by the sum unless it is already 1 (within ``tol``); a zero sum gives NULL weights."""
    total = weights.agg(F.sum("weight").alias("__t"))
    w = F.when(F.abs(F.col("__t") - 1.0) <= tol, F.col("weight")).otherwise(
        F.when(F.col("__t") != 0, F.col("weight") / F.col("__t"))
    )
    return weights.crossJoin(one_row_broadcast(total)).select("model", w.alias("weight"))


def blend(
    preds: DataFrame,
    weights: DataFrame,
    key: str,
    shift: float | str | None = None,
    clamp: float | None = None,
    set_col: str | None = None,
) -> DataFrame:
    """Σ wᵢ·pᵢ over models with wᵢ > 0 in log space, then expm1 − shift (M6), optional clamp.

    ``weights`` has one row per model (per weight set when ``set_col`` is given, B8), so the
    broadcast is bounded by models × weight sets.
    """
    w = weights.filter(F.col("weight") > 0)
    gkeys = [set_col, key] if set_col else [key]
    joined = preds.join(F.broadcast(w), "model")
    out = joined.groupBy(*gkeys).agg(F.sum(F.col("weight") * F.col("pred")).alias("blend_log"))
    if shift is not None:
        s = F.lit(float(shift)) if isinstance(shift, (int, float)) else F.col(shift)
        val = F.expm1("blend_log") - s
        if clamp is not None:
            val = clamp_min(val, clamp)
        out = out.withColumn("value", val)
    return out


def average_wide(models) -> F.Column:
    """B3 per row: the mean of the models that have a prediction."""
    total = sum((F.coalesce(F.col(m), F.lit(0.0)) for m in models), F.lit(0.0))
    return total / sum((F.col(m).isNotNull().cast("int") for m in models), F.lit(0))


def blend_wide(wide: DataFrame, weights: DataFrame, models, keep, shift: str | None = None, clamp: float | None = None, set_col: str | None = None) -> DataFrame:
    """B5 on wide predictions: ``keep``, blend_log = Σ wᵢ·pᵢ over models with wᵢ > 0, and value (expm1 − shift, clamped).

    The weights are one row (one per weight set, B8), which is broadcast; rows are never shuffled.
    """
    w = weights.groupBy(*([set_col] if set_col else [])).pivot("model", list(models)).agg(F.first("weight"))
    w = w.select(*([set_col] if set_col else []), *[F.col(m).alias(f"__w_{m}") for m in models])
    out = wide.crossJoin(F.broadcast(w))
    parts = [F.when(F.col(f"__w_{m}") > 0, F.col(f"__w_{m}") * F.col(m)) for m in models]
    out = out.withColumn("blend_log", F.when(F.coalesce(*parts).isNotNull(), sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))))
    cols = [*([set_col] if set_col else []), *keep, "blend_log"]
    if shift is None:
        return out.select(*cols)
    value = F.expm1("blend_log") - F.col(shift)
    return out.select(*cols, (value if clamp is None else clamp_min(value, clamp)).alias("value"))


def error_gram(wide: DataFrame, models, y: str = "y") -> tuple[np.ndarray, int]:
    """E = Σ e eᵀ with e = p − y per row, from one narrow pass over wide predictions (m×m)."""
    G, _, _, n = gram(wide.select(*[(F.col(m) - F.col(y)).alias(m) for m in models]), list(models), None, intercept=False)
    return G, n


def weight_trials(spark, models, n_trials: int, seed: int = 42) -> DataFrame:
    """Random weights in [0, 1) per (trial, model) from md5(trial-model-seed), normalised per trial.

    Generated on the executors from ``range``; reproducible in any engine with md5.
    """
    trials = spark.range(n_trials).withColumnRenamed("id", "trial")
    cols = {}
    for m in models:
        h = F.md5(F.concat_ws("-", F.col("trial").cast("string"), F.lit(m), F.lit(str(seed))))
        cols[m] = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    wide = trials.select("trial", *[v.alias(m) for m, v in cols.items()])
    total = sum((F.col(m) for m in models), F.lit(0.0))
    return wide.select("trial", *[(F.col(m) / total).alias(m) for m in models])


def weight_search(wide: DataFrame, models, n_trials: int = 3000, seed: int = 42):
    """Score any number of normalised weight vectors with one pass over wide predictions.

    Since Σw = 1, RMSE²(w) = wᵀEw / n with E the error Gram; each trial is a narrow column
    expression on the trials table (the m×m Gram is inlined as literals).
    Returns (scored trials, best trial row).
    """
    E, n = error_gram(wide, models)
    trials = weight_trials(wide.sparkSession, models, n_trials, seed)
    quad = F.lit(0.0)
    for i, a in enumerate(models):
        for j, b in enumerate(models):
            quad = quad + F.lit(float(E[i, j])) * F.col(a) * F.col(b)
    scored = trials.withColumn("rmse", F.sqrt(quad / F.lit(float(n))))
    best = scored.agg(F.min_by(F.struct(*models, "trial"), F.struct("rmse", "trial")).alias("b"), F.min("rmse").alias("rmse"))
    best = best.select(F.col("b.trial").alias("trial"), *[F.col(f"b.{m}").alias(m) for m in models], "rmse")
    return scored, best


def best_weights(wide: DataFrame, models, n_trials: int = 3000, seed: int = 42) -> DataFrame:
    """The exact optimum that B7's trials are searched for: (model, weight, rmse, best_trial_rmse).

    The weights of least RMSE among all that are not negative and sum to 1, from the same error Gram.
    """
    E, n = error_gram(wide, models)
    w = simplex_weights(E)
    rmse = float(np.sqrt(max(w @ E @ w, 0.0) / n))
    _, best = weight_search(wide, models, n_trials, seed)
    tried = best.first()["rmse"]
    return wide.sparkSession.createDataFrame([(m, float(x), rmse, tried) for m, x in zip(models, w)], "model string, weight double, rmse double, best_trial_rmse double")


def stack_nonneg(wide: DataFrame, models, alphas=(0.001, 0.01, 0.1, 1.0, 10.0)):
    """Non-negative ridge stacking without intercept for each α (PᵀP, Pᵀy from one narrow pass),
    weights rescaled to sum 1, best RMSE wins. Returns a small DataFrame (alpha, model, weight, rmse)."""
    PtP, Pty, yy, n = gram(wide, list(models), "y", intercept=False)
    rows = []
    for a in alphas:
        w = nonneg_ridge(PtP, Pty, a)
        if w.sum() > 0:
            w = w / w.sum()
        rss = yy - 2 * w @ Pty + w @ PtP @ w
        rmse = float(np.sqrt(max(rss, 0.0) / n))
        rows += [(float(a), m, float(wi), rmse) for m, wi in zip(models, w)]
    return wide.sparkSession.createDataFrame(rows, "alpha double, model string, weight double, rmse double")
