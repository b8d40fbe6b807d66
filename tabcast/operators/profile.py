"""One-pass table profilers.

Each profiler is a single aggregate over all requested columns (wide row), then turned
long with ``stack`` — one scan of the table whatever the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcast.operators.impute import exact_quantiles
from tabcast.operators.joins import one_row_broadcast


def _stack(wide: DataFrame, names, fields, name_col: str = "column", keep=()) -> DataFrame:
    """Wide one-row aggregate with columns ``{name}__{field}`` → one row per name (+ ``keep`` columns)."""
    n = len(names)
    args = ", ".join([f"'{nm}', " + ", ".join(f"`{nm}__{f}`" for f in fields) for nm in names])
    return wide.selectExpr(f"stack({n}, {args}) as ({name_col}, {', '.join(fields)})", *keep)


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """A1: min, max, mean and number of negative values of the target, plus the M4 shift."""
    t = F.col(target)
    return df.agg(
        F.min(t).alias("min"),
        F.max(t).alias("max"),
        F.avg(t).alias("mean"),
        F.count_if(t < 0).alias("n_negative"),
        F.when(F.min(t) < 0, F.abs(F.min(t)) + 1).otherwise(F.lit(0.0)).alias("shift"),
    )


def moments(df: DataFrame, cols) -> DataFrame:
    """A2: mean, exact median, sample std, min, max, population skewness, #negative per column."""
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.count(x).alias(f"{c}__n"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).cast("double").alias(f"{c}__min"),
            F.max(x).cast("double").alias(f"{c}__max"),
            F.skewness(x).alias(f"{c}__skew"),
            F.count_if(x < 0).alias(f"{c}__n_negative"),
        ]
    wide = df.agg(*aggs)
    med = exact_quantiles(df, cols, 0.5)
    wide = wide.withColumns({f"{c}__median": F.lit(med[c]).cast("double") for c in cols})
    return _stack(wide, cols, ["n", "mean", "median", "std", "min", "max", "skew", "n_negative"])


def skew_report(df: DataFrame, target: str, transformed: Column, label: str = "log") -> DataFrame:
    """A3: skewness before and after a transform and the reduction |before| − |after| (one pass)."""
    return df.agg(
        F.skewness(target).alias("skew_before"),
        F.skewness(transformed).alias("skew_after"),
    ).withColumn("reduction", F.abs("skew_before") - F.abs("skew_after")).withColumn("transform", F.lit(label))


def describe(df: DataFrame, cols) -> DataFrame:
    """A4: count, mean, population-free sample std, min, exact 25/50/75 %, max (numbers, not strings)."""
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).cast("double").alias(f"{c}__min"),
            F.max(x).cast("double").alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    qs = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    wide = wide.withColumns(
        {f"{c}__p{int(q * 100)}": F.lit(qs[q][c]).cast("double") for q in qs for c in cols}
    )
    return _stack(wide, cols, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """A5: missing count and fraction per column, one scan."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__n_missing") for c in cols]
    long = _stack(df.agg(*aggs), cols, ["n_missing"], keep=("__rows",))
    return long.select("column", "n_missing", (F.col("n_missing") / F.col("__rows")).alias("frac_missing"))


def cardinality_profile(df: DataFrame, cols, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values per column (NULL not counted); HyperLogLog++ when ``approx``."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    wide = df.agg(*[fn(c).alias(f"{c}__n_distinct") for c in cols])
    return _stack(wide, cols, ["n_distinct"])


def corr_with(df: DataFrame, cols, target: str) -> DataFrame:
    """A7+A8: Pearson r of each column with the target (pairwise-complete rows), |r| and band."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"{c}__r") for c in cols])
    long = _stack(wide, cols, ["r"], name_col="feature")
    # Band limits on |r|.
    band = F.when(F.abs("r") > 0.3, "strong").when(F.abs("r") > 0.15, "moderate").otherwise("weak")
    return long.withColumns({"abs_r": F.abs("r"), "band": band})


def top_bottom(df: DataFrame, by: str, k: int = 3, tie: str | None = None) -> DataFrame:
    """K2: the k largest and k smallest rows by ``by`` (TakeOrdered: per-partition top-k, then merge)."""
    order_tie = [F.col(tie)] if tie else []
    top = df.orderBy(F.col(by).desc(), *order_tie).limit(k).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(by).asc(), *order_tie).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def histogram(df: DataFrame, col: str | Column, bins: int = 50, name: str = "value") -> DataFrame:
    """Equal-width bins between min and max, last bin closed; (bin, lo, hi, n), empty bins kept."""
    x = F.col(col) if isinstance(col, str) else col
    base = df.select(x.cast("double").alias(name)).filter(F.col(name).isNotNull() & ~F.isnan(name))
    rng = base.agg(F.min(name).alias("__lo"), F.max(name).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    b = F.when(width == 0, F.lit(0)).otherwise(F.floor((F.col(name) - F.col("__lo")) / width))
    counts = (
        base.crossJoin(one_row_broadcast(rng))
        .withColumn("bin", F.least(b.cast("int"), F.lit(bins - 1)))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(
        one_row_broadcast(rng)
    )
    return (
        all_bins.join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("__lo") + F.col("bin") * width).alias("lo"),
            (F.col("__lo") + (F.col("bin") + 1) * width).alias("hi"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def arg_min(df: DataFrame, item: str, score: str, group: str | None = None) -> DataFrame:
    """K5: the item with the smallest score (ties → smallest item), optionally per group."""
    agg = F.min_by(F.col(item), F.struct(score, item)).alias(item)
    best = F.min(score).alias(score)
    return df.groupBy(group).agg(agg, best) if group else df.agg(agg, best)
