"""Regression metrics as single aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def metric_aggs(y: str | Column, p: str | Column, mape: bool = True) -> list[Column]:
    """RMSE, MAE, R² (1 − SSE/SST, population variance) and MAPE over y ≠ 0 (plus how many y = 0)."""
    y, p = _c(y).cast("double"), _c(p).cast("double")
    e = y - p
    out = [
        F.count(e).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.avg(e * e) / F.var_pop(y)).alias("r2"),
    ]
    if mape:
        out += [
            (F.avg(F.when(y != 0, F.abs(e / y))) * F.lit(100.0)).alias("mape"),
            F.count_if(y == 0).alias("n_zero_y"),
        ]
    return out


def metrics(df: DataFrame, y: str, p: str, by=None, mape: bool = True) -> DataFrame:
    """A10 (and A11 when given expm1 columns); ``by`` groups, e.g. model or fold."""
    aggs = metric_aggs(y, p, mape)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def original_scale_rmse(df: DataFrame, y_log: str, p_log: str, shift: float | str = 0.0) -> DataFrame:
    """RMSE after expm1 − shift of both columns."""
    s = F.lit(shift) if isinstance(shift, (int, float)) else F.col(shift)
    y = F.expm1(F.col(y_log)) - s
    p = F.expm1(F.col(p_log)) - s
    return df.agg(F.sqrt(F.avg((y - p) * (y - p))).alias("rmse_original"))


def model_scores(preds: DataFrame, y: str = "y", p: str = "pred", model: str = "model") -> DataFrame:
    """RMSE, MAE, R² per model, sorted best first."""
    return metrics(preds, y, p, by=[model], mape=False).orderBy("rmse", model)


def relative_improvement(scores: DataFrame, blends, model: str = "model") -> DataFrame:
    """% RMSE gain of each blend over the best single (non-blend) model."""
    singles = scores.filter(~F.col(model).isin(*blends))
    best = singles.agg(
        F.min_by(model, F.struct("rmse", model)).alias("best_model"), F.min("rmse").alias("best_rmse")
    )
    return (
        scores.filter(F.col(model).isin(*blends))
        .crossJoin(F.broadcast(best))
        .select(
            F.col(model),
            "rmse",
            "best_model",
            "best_rmse",
            ((F.col("best_rmse") - F.col("rmse")) / F.col("best_rmse") * F.lit(100.0)).alias("improvement_pct"),
        )
    )


def prediction_summary(df: DataFrame, p: str) -> DataFrame:
    """Min, max, mean and exact median of predictions.

    The median uses the bounded-band exact quantile (never Spark's ``median`` aggregate,
    which keeps every distinct value of the column in one task's memory).
    """
    from tabcast.operators.impute import exact_quantiles

    x = F.col(p)
    med = exact_quantiles(df, [p], 0.5)[p]
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean")).withColumn(
        "median", F.lit(med).cast("double")
    )


def fold_mean(df: DataFrame, y: str, p: str, fold: str = "fold", by=None) -> DataFrame:
    """Mean of per-fold RMSE (differs from the RMSE of the pooled predictions)."""
    by = list(by or [])
    per_fold = df.groupBy(*by, fold).agg(F.sqrt(F.avg((F.col(y) - F.col(p)) ** 2)).alias("fold_rmse"))
    out = per_fold.groupBy(*by).agg(
        F.avg("fold_rmse").alias("mean_fold_rmse"), F.stddev_samp("fold_rmse").alias("std_fold_rmse")
    )
    return out


def residuals(df: DataFrame, y: str, p: str, keep=()) -> DataFrame:
    """Residual y − p beside the prediction."""
    return df.select(*keep, F.col(p).alias("pred"), (F.col(y) - F.col(p)).alias("residual"))
