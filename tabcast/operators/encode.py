"""Category encoders and scaling.

Fitted state is always a small keyed DataFrame (``column, value, …``) joined back to the
rows; nothing is collected to the driver except one-row aggregates.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabcast.operators.joins import bounded_broadcast, one_row_broadcast
from tabcast.operators.split import rank_within

# ---------------------------------------------------------------- label encoding


def _long_values(df: DataFrame, cols, ids=(), value_type: str = "string") -> DataFrame:
    """(ids…, column, value) for every cell of ``cols``: one scan (Expand), not one per column."""
    wide = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return wide.unpivot(list(ids), list(cols), "column", "value")


def fit_label_dictionary(df: DataFrame, cols) -> DataFrame:
    """Per column, sorted distinct values → codes 0..n−1 (``column, value, code``).

    Distinct runs as a partial (map-side) aggregate; codes come from a range-partitioned rank,
    so even a column with billions of distinct values is never ranked inside one task.
    """
    distinct = _long_values(df, cols).filter(F.col("value").isNotNull()).distinct()
    ranked = rank_within(distinct, "column", "value", col="code")
    return ranked.withColumn("code", F.col("code").cast("int"))


def apply_label_dictionary(df: DataFrame, dictionary: DataFrame, cols, unseen: int | None = None) -> DataFrame:
    """Value → code for each column; an unseen value gives ``unseen`` (NULL by default, −1 for E2)."""
    out = df
    small = bounded_broadcast(dictionary)
    for c in cols:
        d = small.filter(F.col("column") == F.lit(c)).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__code_{c}")
        )
        out = out.join(d, out[c].cast("string") == d[f"__v_{c}"], "left")
        code = F.col(f"__code_{c}")
        if unseen is not None:
            code = F.coalesce(code, F.lit(unseen))
        out = out.withColumn(c, code.cast("int")).drop(f"__v_{c}", f"__code_{c}")
    return out


def label_encode(fit_df: DataFrame, apply_df: DataFrame, cols, unseen: int | None = None):
    """E1 (fit on union) / E2 (fit on train, unseen → −1). Returns (encoded, dictionary)."""
    dictionary = fit_label_dictionary(fit_df, cols)
    return apply_label_dictionary(apply_df, dictionary, cols, unseen), dictionary


# ---------------------------------------------------------------- one-hot


def fit_one_hot(train: DataFrame, cols, suffix: str = "_ohe"):
    """Alphabetical index, unseen/NULL → all zeros (handleInvalid='keep' + dropLast)."""
    stages = []
    for c in cols:
        stages.append(
            StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
        )
    stages.append(
        OneHotEncoder(
            inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=True
        )
    )
    return Pipeline(stages=stages).fit(train)


def one_hot_position(vec_col: str) -> F.Column:
    """Index of the 1 in a one-hot vector, −1 for the all-zero vector."""
    return (F.array_position(vector_to_array(F.col(vec_col)), F.lit(1.0)) - 1).cast("int")


# ---------------------------------------------------------------- target encoding


def sigmoid_weight(n: F.Column, min_leaf: float, smoothing: float) -> F.Column:
    """λ(n) = 1 / (1 + exp(−(n − min_leaf)/smoothing)) — weight of the category mean."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(min_leaf))) / F.lit(float(smoothing))))


def additive_weight(n: F.Column, smoothing: float) -> F.Column:
    """λ(n) = n / (n + smoothing) (the form of Spark ML's TargetEncoder)."""
    return n / (n + F.lit(float(smoothing)))


def _blend(n, mean, prior, min_leaf, smoothing, mode):
    lam = sigmoid_weight(n, min_leaf, smoothing) if mode == "sigmoid" else additive_weight(n, smoothing)
    return prior * (F.lit(1.0) - lam) + mean * lam


def fit_target_encoding(
    df: DataFrame, cols, target: str, smoothing: float = 1.0, min_leaf: int = 20, mode: str = "sigmoid"
) -> tuple[DataFrame, DataFrame]:
    """E5 fit: (column, value, n, mean, encoded) plus the one-row prior (global mean).

    One partial aggregate per (column, value): a hot category is combined map-side before the
    shuffle, so skew costs one row per partition, not a third of the table in one task.
    """
    prior = df.agg(F.avg(target).alias("prior"))
    stats = (
        _long_values(df.withColumn("__y", F.col(target)), cols, ids=("__y",))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("__y").alias("n"), F.avg("__y").alias("mean"))
    )
    stats = stats.crossJoin(one_row_broadcast(prior))
    enc = stats.withColumn("encoded", _blend(F.col("n"), F.col("mean"), F.col("prior"), min_leaf, smoothing, mode))
    return enc.select("column", "value", "n", "mean", "encoded"), prior


def apply_target_encoding(df: DataFrame, encoding: DataFrame, prior: DataFrame, cols, suffix: str = "") -> DataFrame:
    """E5 apply: value → encoded; unseen or NULL → prior (global mean)."""
    out = df.crossJoin(one_row_broadcast(prior.select(F.col("prior").alias("__prior"))))
    small = bounded_broadcast(encoding.select("column", "value", "encoded"))
    for c in cols:
        e = small.filter(F.col("column") == F.lit(c)).select(
            F.col("value").alias(f"__v_{c}"), F.col("encoded").alias(f"__e_{c}")
        )
        out = out.join(e, out[c].cast("string") == e[f"__v_{c}"], "left")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"__e_{c}"), F.col("__prior"))).drop(
            f"__v_{c}", f"__e_{c}"
        )
    return out.drop("__prior")


def target_encode(fit_df, apply_df, cols, target, smoothing=1.0, min_leaf=20, mode="sigmoid", suffix=""):
    """E5 (and E7 when ``fit_df`` is the whole labelled table)."""
    enc, prior = fit_target_encoding(fit_df, cols, target, smoothing, min_leaf, mode)
    return apply_target_encoding(apply_df, enc, prior, cols, suffix)


def target_encode_oof(
    df: DataFrame,
    cols,
    target: str,
    fold: str = "fold",
    smoothing: float = 1.0,
    min_leaf: int = 20,
    mode: str = "sigmoid",
    suffix: str = "",
) -> DataFrame:
    """Each row encoded by statistics of the *other* folds only (leak-free), for all folds at once.

    Sums per (value, fold) are computed once; fold f's statistics are total − fold-f. The
    target is centred on its global mean first so that the subtraction does not cancel digits
    on very large tables. One join per column with a table of (distinct values × k) rows.
    """
    centre = df.agg(F.avg(target).alias("__c"))
    y = F.col(target) - F.col("__c")
    base = df.crossJoin(one_row_broadcast(centre))
    fold_tot = base.groupBy(fold).agg(F.count(target).alias("__nf"), F.sum(y).alias("__sf"))
    all_tot = fold_tot.agg(F.sum("__nf").alias("__N"), F.sum("__sf").alias("__S"))
    priors = fold_tot.crossJoin(one_row_broadcast(all_tot)).select(
        F.col(fold),
        ((F.col("__S") - F.col("__sf")) / (F.col("__N") - F.col("__nf"))).alias("__prior_c"),
    )
    out = base.join(F.broadcast(priors), fold)  # k rows
    # one scan + one partial aggregate for every column: (column, value, fold) → n, sum
    per = (
        _long_values(base.withColumn("__yc", y), cols, ids=("__yc", fold))
        .groupBy("column", "value", fold)
        .agg(F.count("__yc").alias("__n"), F.sum("__yc").alias("__s"))
    )
    tot = per.groupBy("column", "value").agg(F.sum("__n").alias("__nt"), F.sum("__s").alias("__st"))
    rest = per.join(tot, ["column", "value"]).select(
        "column", "value", F.col(fold).alias("__f"),
        (F.col("__nt") - F.col("__n")).alias("__nr"), (F.col("__st") - F.col("__s")).alias("__sr"),
    )
    rest = bounded_broadcast(rest)
    for c in cols:
        r = rest.filter(F.col("column") == F.lit(c)).drop("column").withColumnRenamed("value", "__v")
        out = out.join(r, (out[c].cast("string") == r["__v"]) & (out[fold] == r["__f"]), "left")
        nr = F.col("__nr")
        mean_c = F.col("__sr") / nr
        enc_c = F.when(nr > 0, _blend(nr, mean_c, F.col("__prior_c"), min_leaf, smoothing, mode)).otherwise(
            F.col("__prior_c")
        )
        out = out.withColumn(f"{c}{suffix}", enc_c + F.col("__c")).drop("__v", "__f", "__nr", "__sr")
    return out.drop("__prior_c", "__c")


def target_encode_folds(
    df: DataFrame, cols, target: str, fold: str, k: int, smoothing: float | dict[str, float] = 1.0, min_leaf: int = 20, mode: str = "sigmoid", suffix: str = "__te"
) -> DataFrame:
    """E5 fitted without each fold, side by side: columns ``{c}{suffix}{f}`` hold the encoding fitted on the rows outside fold f.

    Within column f, rows outside f see their own target, as an encoder fitted on a training set does;
    rows of f do not. One aggregate over all columns (sums per value and fold; fold f's are the total
    minus its own, on the centred target) and one join per column; unseen or NULL gives f's prior. Rows whose
    fold is not in 0 to k − 1 belong to every training set. ``smoothing`` may name several by their suffixes: they share
    the aggregate and the joins.
    """
    smoothings = smoothing if isinstance(smoothing, dict) else {suffix: smoothing}
    centre = df.agg(F.avg(target).alias("__c"))
    base = df.crossJoin(one_row_broadcast(centre)).withColumn("__yc", F.col(target) - F.col("__c"))
    of = F.col(fold).cast("int")
    sums = [F.count("__yc").alias("n"), F.sum("__yc").alias("s")]
    for f in range(k):
        sums += [F.count(F.when(of == f, F.col("__yc"))).alias(f"n{f}"), F.coalesce(F.sum(F.when(of == f, F.col("__yc"))), F.lit(0.0)).alias(f"s{f}")]
    rest = lambda f: (F.col("n") - F.col(f"n{f}"), F.col("s") - F.col(f"s{f}"))
    priors = base.agg(*sums).select(*[F.when(rest(f)[0] > 0, rest(f)[1] / rest(f)[0]).otherwise(0.0).alias(f"__p{f}") for f in range(k)])
    stats = _long_values(base.select("__yc", of.alias(fold), *cols), cols, ids=("__yc", fold)).where("value IS NOT NULL").groupBy("column", "value").agg(*sums)
    stats = stats.crossJoin(one_row_broadcast(priors))
    encoded = []
    for i, smooth in enumerate(smoothings.values()):
        for f in range(k):
            n, s = rest(f)
            prior = F.col(f"__p{f}")
            encoded.append(F.when(n > 0, _blend(n, s / n, prior, min_leaf, smooth, mode)).otherwise(prior).alias(f"e{i}_{f}"))
    small = bounded_broadcast(stats.select("column", "value", *encoded))
    out = base.drop("__yc").crossJoin(one_row_broadcast(priors))
    # All new columns are named at the end, so that the plan of many columns is analysed once.
    new = []
    for j, c in enumerate(cols):
        name = lambda i, f, j=j: f"__e{j}_{i}_{f}"
        mine = small.where(F.col("column") == F.lit(c)).select(F.col("value").alias(f"__v{j}"), *[F.col(f"e{i}_{f}").alias(name(i, f)) for i in range(len(smoothings)) for f in range(k)])
        out = out.join(mine, out[c].cast("string") == F.col(f"__v{j}"), "left")
        new += [(F.coalesce(F.col(name(i, f)), F.col(f"__p{f}")) + F.col("__c")).alias(f"{c}{end}{f}") for i, end in enumerate(smoothings) for f in range(k)]
    return out.select(*df.columns, *new)


def ordered_target_stat(
    df: DataFrame,
    col: str,
    target: str,
    key: str,
    seed: int = 42,
    prior_weight: float = 1.0,
    bucket_digits: int | None = None,
    decimal_scale: int | None = None,
    out: str | None = None,
) -> DataFrame:
    """Running mean of the target over *earlier* rows of the same category in a seeded
    random order (md5 of key ‖ seed), smoothed by ``prior_weight`` pseudo-rows at the prior.

    Skew-safe two-level prefix sum: rows go to 16^bucket_digits buckets by the leading hex
    digits of the same hash that orders them, so bucket order agrees with row order. By default
    the digit count grows with the row count so that a window partition stays near 1M rows. The
    window over rows is partitioned by (category, bucket) — a hot category is spread over
    all buckets — and bucket totals are prefix-summed in a table of categories × buckets rows.
    """
    out = out or f"{col}_ots"
    if bucket_digits is None:  # ~≤ 1M rows per (category, bucket) even if one category holds every row
        n = df.count()
        bucket_digits = max(2, math.ceil(math.log(max(n, 1) / 1_000_000, 16))) if n > 0 else 2
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    yv = F.col(target).cast(f"decimal(28,{decimal_scale})") if decimal_scale is not None else F.col(target)
    base = df.withColumns({"__h": h, "__y": yv}).withColumn("__b", F.substring("__h", 1, bucket_digits))
    prior = df.agg(F.avg(target).alias("__prior"))
    buckets = base.groupBy(col, "__b").agg(F.count("__y").alias("__bn"), F.sum("__y").alias("__bs"))
    before = Window.partitionBy(col).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bucket_prefix = buckets.select(
        col,
        "__b",
        F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__pn"),
        F.sum("__bs").over(before).alias("__ps"),
    )
    win = Window.partitionBy(col, "__b").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumns(
        {"__in_n": F.coalesce(F.count("__y").over(win), F.lit(0)), "__in_s": F.sum("__y").over(win)}
    )
    bp = bounded_broadcast(bucket_prefix.withColumnRenamed(col, "__bc").withColumnRenamed("__b", "__bb"))
    cond = rows[col].eqNullSafe(bp["__bc"]) & (rows["__b"] == bp["__bb"])  # NULL is a category of its own
    joined = rows.join(bp, cond, "left").drop("__bc", "__bb").crossJoin(one_row_broadcast(prior))
    n_before = F.col("__pn") + F.col("__in_n")
    s_before = F.coalesce(F.col("__ps"), F.lit(0)) + F.coalesce(F.col("__in_s"), F.lit(0))
    value = (s_before.cast("double") + F.lit(prior_weight) * F.col("__prior")) / (n_before + F.lit(prior_weight))
    return joined.withColumns(
        {f"{out}_n": n_before, f"{out}_sum": s_before.cast("double"), out: value}
    ).drop("__h", "__y", "__b", "__pn", "__ps", "__in_n", "__in_s", "__prior")


def ordered_target_stats(
    df: DataFrame,
    cols,
    target: str,
    key: str,
    seed: int = 42,
    prior_weight: float = 1.0,
    bucket_digits: int | None = None,
    suffix: str = "_ots",
) -> DataFrame:
    """E8 for many columns in one pass: unpivot to (key, column, value, y), the same two-level
    prefix sums partitioned by (column, value, bucket), pivot back with one shuffle on the key.
    A row whose category is NULL gets the statistic of the NULL group, as in the one-column form."""
    cols = list(cols)
    if bucket_digits is None:
        n = df.count()
        bucket_digits = max(2, math.ceil(math.log(max(n, 1) / 1_000_000, 16))) if n > 0 else 2
    prior = df.agg(F.avg(target).alias("__prior"))
    long = _long_values(df.withColumn("__y", F.col(target).cast("double")), cols, ids=(key, "__y"))
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    long = long.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, bucket_digits))
    grp = ["column", "value"]
    buckets = long.groupBy(*grp, "__b").agg(F.count("__y").alias("__bn"), F.sum("__y").alias("__bs"))
    before = Window.partitionBy(*grp).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = buckets.select(
        F.col("column").alias("__pc"), F.col("value").alias("__pv"), F.col("__b").alias("__pb"),
        F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__pn"), F.sum("__bs").over(before).alias("__ps"),
    )
    win = Window.partitionBy(*grp, "__b").orderBy("__h", key).rowsBetween(Window.unboundedPreceding, -1)
    rows = long.withColumns(
        {"__in_n": F.coalesce(F.count("__y").over(win), F.lit(0)), "__in_s": F.sum("__y").over(win)}
    )
    bp = bounded_broadcast(prefix)
    cond = (rows["column"] == bp["__pc"]) & rows["value"].eqNullSafe(bp["__pv"]) & (rows["__b"] == bp["__pb"])
    joined = rows.join(bp, cond, "left").crossJoin(one_row_broadcast(prior))
    n_before = F.coalesce(F.col("__pn"), F.lit(0)) + F.col("__in_n")
    s_before = F.coalesce(F.col("__ps"), F.lit(0.0)) + F.coalesce(F.col("__in_s"), F.lit(0.0))
    stat = (s_before + F.lit(prior_weight) * F.col("__prior")) / (n_before + F.lit(prior_weight))
    wide = joined.select(key, "column", stat.alias("__ots")).groupBy(key).pivot("column", cols).agg(F.first("__ots"))
    wide = wide.select(key, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return df.join(wide, key)


# ---------------------------------------------------------------- scaling / projection


def fit_standard_scaler(train: DataFrame, cols) -> DataFrame:
    """E9 fit: one-row table of means and *population* std per column (zero std → 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return train.agg(*aggs)


def apply_standard_scaler(df: DataFrame, stats: DataFrame, cols, suffix: str = "") -> DataFrame:
    out = df.crossJoin(one_row_broadcast(stats))
    for c in cols:
        sd = F.col(f"{c}__std")
        sd = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"{c}__mean")) / sd)
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def pca_variance(df: DataFrame, cols, threshold: float = 0.95, features_col: str = "__x"):
    """Centre (one-row means), fit PCA with all components, return
    (k, table of component/explained/cumulative, fitted k-component model, centred frame).

    The covariance is a distributed aggregate (d×d); only it reaches the driver. ``df`` is read in several passes and not held.
    """
    means = df.agg(*[F.avg(c).alias(f"{c}__m") for c in cols])
    centred = df.crossJoin(one_row_broadcast(means))
    centred = centred.withColumns({c: F.col(c) - F.col(f"{c}__m") for c in cols}).drop(*[f"{c}__m" for c in cols])
    assembled = VectorAssembler(inputCols=list(cols), outputCol=features_col, handleInvalid="keep").transform(centred)
    full = PCA(k=len(cols), inputCol=features_col, outputCol="__pca_all").fit(assembled)
    ev = [float(v) for v in full.explainedVariance.toArray()]
    cum, k = 0.0, len(cols)
    rows = []
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, v, cum))
    for comp, _, c in rows:
        if c >= threshold - 1e-12:
            k = comp
            break
    table = df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")
    model = PCA(k=k, inputCol=features_col, outputCol="pca").fit(assembled)
    return k, table, model, assembled
