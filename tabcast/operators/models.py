"""Model fit/predict on Spark ML.

Boosting libraries are not rebuilt: every model is a Spark ML estimator whose training
passes are distributed (tree histograms by ``maxBins``, L-BFGS / normal equations by
treeAggregate). All frames keep their key; ``predict`` returns ``(key, pred)``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "features"


def assemble(df: DataFrame, cols, out: str = FEATURES, invalid: str = "keep") -> DataFrame:
    """Dense feature vector; ``invalid='keep'`` turns NULL into NaN (impute first for trees),
    ``'skip'`` drops rows with a NULL feature."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def label_sd(df: DataFrame, label: str, population: bool) -> float:
    fn = F.stddev_pop if population else F.stddev_samp
    return float(df.agg(fn(label).alias("s")).first()["s"] or 1.0)


@dataclass
class LinearSpec:
    """Objective in the reference's terms.

    kind='ols'  : ‖r‖²
    kind='ridge': ‖r‖² + alpha‖w‖²
    kind='lasso': (1/2n)‖r‖² + alpha‖w‖₁
    kind='enet' : (1/2n)‖r‖² + alpha·l1‖w‖₁ + alpha(1−l1)/2‖w‖²
    """

    kind: str = "ols"
    alpha: float = 0.0
    l1_ratio: float = 0.5


def spark_linear_params(spec: LinearSpec, n: int, sd_y: float) -> tuple[float, float]:
    """Map the objective to Spark's (regParam, elasticNetParam) with ``standardization=False``.

    In Spark's form λ₁ is kept and λ₂ acts divided by the label's standard deviation, so
    regParam = λ₁ + λ₂σ and elasticNetParam = λ₁/(λ₁ + λ₂σ). Ridge's ‖r‖² + α‖w‖² is
    (1/2n)‖r‖² + (α/2n)‖w‖², i.e. λ₂ = α/n.
    """
    if spec.kind == "ols":
        return 0.0, 0.0
    if spec.kind == "ridge":
        l1, l2 = 0.0, spec.alpha / n
    elif spec.kind == "lasso":
        l1, l2 = spec.alpha, 0.0
    else:
        l1, l2 = spec.alpha * spec.l1_ratio, spec.alpha * (1.0 - spec.l1_ratio)
    reg = l1 + l2 * sd_y
    return reg, (l1 / reg if reg > 0 else 0.0)


def fit_linear(train: DataFrame, label: str, spec: LinearSpec, features: str = FEATURES, max_iter: int = 50, tol: float = 1e-6):
    """L1/L2/L4/L5 on assembled features."""
    n = train.count()
    solver = "normal" if spec.kind in ("ols", "ridge") else "auto"
    sd = label_sd(train, label, population=(solver == "normal")) if spec.kind != "ols" else 1.0
    reg, en = spark_linear_params(spec, n, sd)
    lr = LinearRegression(
        featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=en, standardization=False,
        solver=solver, maxIter=max_iter, tol=tol,
    )
    return lr.fit(train)


def fit_tree(train: DataFrame, label: str, max_depth: int | None = 10, min_leaf: int = 20, max_bins: int = 64,
             features: str = FEATURES, seed: int = 42):
    """A regression tree; depth None → 30 (Spark's limit)."""
    return DecisionTreeRegressor(
        featuresCol=features, labelCol=label, maxDepth=30 if max_depth is None else max_depth,
        minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed,
    ).fit(train)


def fit_forest(train: DataFrame, label: str, n_trees: int = 20, max_depth: int = 10, min_leaf: int = 2,
               feature_fraction: float | str = "onethird", subsample: float = 1.0, max_bins: int = 64,
               features: str = FEATURES, seed: int = 42):
    """Random forest (bootstrap rows, per-node feature sampling)."""
    fss = str(feature_fraction) if not isinstance(feature_fraction, str) else feature_fraction
    return RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=n_trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=fss, subsamplingRate=subsample, maxBins=max_bins, seed=seed,
    ).fit(train)


def fit_gbt(train: DataFrame, label: str, n_iter: int = 50, lr: float = 0.1, max_depth: int = 6, min_leaf: int = 1,
            subsample: float = 1.0, feature_fraction: float | str = "all", validation_col: str | None = None,
            max_bins: int = 64, features: str = FEATURES, seed: int = 42):
    """Gradient boosting with squared loss; row subsampling and per-node column sampling
    stand in for the boosting libraries' options; ``validation_col`` enables Spark's early stop."""
    fss = str(feature_fraction) if not isinstance(feature_fraction, str) else feature_fraction
    kw = dict(
        featuresCol=features, labelCol=label, maxIter=n_iter, stepSize=lr, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, subsamplingRate=subsample, featureSubsetStrategy=fss, lossType="squared",
        maxBins=max_bins, seed=seed,
    )
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTRegressor(**kw).fit(train)


def learning_curve(model, frames: dict, label: str) -> list[tuple[int, str, float]]:
    """RMSE after each boosting iteration on each named frame (one pass per frame)."""
    rows = []
    for name, frame in frames.items():
        losses = model.evaluateEachIteration(frame, "squared")
        rows += [(i + 1, name, float(np.sqrt(v))) for i, v in enumerate(losses)]
    return rows


def best_rounds(curve, split: str = "validation", patience: int | None = None) -> int:
    """Arg-min of the validation curve (+1, it is a count — quirk Q5), optionally stopping
    after ``patience`` rounds without gain."""
    vals = [r for (_, s, r) in sorted(curve) if s == split]
    best_i, best_v, since = 0, float("inf"), 0
    for i, v in enumerate(vals):
        if v < best_v - 1e-15:
            best_i, best_v, since = i, v, 0
        else:
            since += 1
            if patience is not None and since >= patience:
                break
    return best_i + 1


def importance_table(spark, model, names) -> DataFrame:
    """(feature, importance) for tree models, (feature, coefficient) for linear ones."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
        kind = "importance"
    else:
        vals = model.coefficients.toArray()
        kind = "coefficient"
    rows = [(n, float(v), kind) for n, v in zip(names, vals)]
    return spark.createDataFrame(rows, "feature string, value double, kind string")



def dtype_dispatch(numeric, categorical, estimator=None, relative_error: float = 1e-4) -> Pipeline:
    """Numeric branch (median impute) + categorical branch (index, one-hot) → one vector.

    The in-pipeline median is Spark's bounded-memory sketch (``relative_error``); use
    ``impute.median_fill`` before the pipeline when the exact median is required.
    """
    stages = []
    num_out = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=num_out, strategy="median",
                              relativeError=relative_error))
    if categorical:
        # One stage, so one pass over the rows, for all columns.
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__idx" for c in categorical],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                                    outputCols=[f"{c}__ohe" for c in categorical], dropLast=True))
    stages.append(VectorAssembler(inputCols=num_out + [f"{c}__ohe" for c in categorical], outputCol=FEATURES,
                                  handleInvalid="keep"))
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def save_model(model, path: str) -> None:
    """Persist a fitted model / pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
