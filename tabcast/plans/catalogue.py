"""Query catalogue: one callable per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All queries read the driver's tables (through ``raw_shipments`` or directly) and run over
whole tables. Oracle SQL for the exactly checkable ones lives in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.functions.dates import date_features, parse_mixed
from tabcast.functions.location import parse_location
from tabcast.functions.mathx import (
    density,
    inverse_target,
    physical_features,
    shift_log,
    true_false_code,
    yes_no_code,
)
from tabcast.operators import encode, ensemble, impute, knn, metrics, profile, split
from tabcast.operators.joins import align
from tabcast.operators.transformer import FeatureEncoder
from tabcast.schema import columns_by_type, existing, separate, FeatureSpec
from tabcast.session import scratch_path, written
from tabcast.sources import sinks
from tabcast.sources.tables import KEY, RAW_CATEGORICAL, RAW_NUMERIC, TARGET, raw_shipments, split_raw, table

LOG = f"{TARGET}_Log"
TEST_SEED = 2024  # seed of the labelled/unlabelled split of the stand-in input
SEED = 42
BASELINE_MODELS = ("group_mean", "line", "mean")
# Hand-picked blend weight sets (mean, group_mean, line), as in a manual grid.
MANUAL_WEIGHT_SETS = {
    "w_100_0_0": (1.0, 0.0, 0.0),
    "w_0_0_100": (0.0, 0.0, 1.0),
    "w_50_0_50": (0.5, 0.0, 0.5),
    "w_64_1_35": (0.64, 0.01, 0.35),
    "w_20_40_40": (0.2, 0.4, 0.4),
}


# ------------------------------------------------------------------ shared stages


def labelled(spark, d) -> DataFrame:
    """Labelled raw rows (the reference's train file)."""
    return split_raw(raw_shipments(spark, d), test_frac=0.1, seed=TEST_SEED)[0]


def unlabelled(spark, d) -> DataFrame:
    return split_raw(raw_shipments(spark, d), test_frac=0.1, seed=TEST_SEED)[1]


def labelled_log(spark, d) -> DataFrame:
    """Labelled rows with the shift (J3) and log target (M4)."""
    return shift_log(labelled(spark, d), TARGET, LOG)


def engineered(spark, d) -> DataFrame:
    """Labelled rows after dates, address and physical features (no encoding)."""
    return physical_features(parse_location(date_features(labelled_log(spark, d)), "Hospital_Location"))


def baseline_preds(spark, d) -> DataFrame:
    """OOF predictions of three closed-form models on the log target (B1)."""
    df = split.kfold(engineered(spark, d), KEY, 5, SEED)
    return ensemble.baseline_oof(df, KEY, LOG, "fold", "Transport_Method", "Equipment_Value")


def baseline_wide(spark, d) -> DataFrame:
    """The same predictions, one row per key, with the shift; written, as every user reads them more than once."""
    df = split.kfold(engineered(spark, d), KEY, 5, SEED)
    wide = ensemble.baseline_oof_wide(df, KEY, LOG, "fold", "Transport_Method", "Equipment_Value", keep=("Target_Shift_Value",))
    return written(wide, "baseline")


# ------------------------------------------------------------------ flagship slice


def q_oof_target_encoding_rmse(spark: SparkSession, d: str) -> DataFrame:
    """Scan → shift/log target → date features → K-fold → leak-free target encoding of the
    transport method → the encoding as prediction → RMSE/MAE/R² per fold."""
    df = date_features(labelled_log(spark, d))
    df = split.kfold(df, KEY, 5, SEED)
    enc = encode.target_encode_oof(df, ["Transport_Method"], LOG, "fold", smoothing=1.0, min_leaf=20, suffix="_te")
    return metrics.metrics(enc, LOG, "Transport_Method_te", by=["fold"], mape=False)


# ------------------------------------------------------------------ sources / scalar functions


def q_raw_shipments(spark, d):
    """S1 source: the shipment-shaped raw rows."""
    return raw_shipments(spark, d)


def q_location_features(spark, d):
    """State, zip, military flag from the free-text address."""
    return parse_location(raw_shipments(spark, d), "Hospital_Location").select(
        KEY, "Location_State", "Location_Zip", "Location_Is_Military"
    )


def q_date_features(spark, d):
    """Strict text-date parse, calendar parts (Mon=0) and lead time."""
    out = date_features(raw_shipments(spark, d))
    cols = [c for c in out.columns if c.startswith(("Order_", "Delivery_"))]
    return out.select(KEY, *cols)


def q_mixed_date_parse(spark, d):
    """Month-first parse over several layouts of the order date."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dt"))
    nib = F.substring(F.md5(F.col("o_orderkey").cast("string")), 12, 1)
    text = (
        F.when(nib.isin("0", "1", "2", "3"), F.date_format("dt", "yyyy-MM-dd"))
        .when(nib.isin("4", "5", "6", "7"), F.date_format("dt", "MM/dd/yyyy"))
        .when(nib == "8", F.lit("not a date"))
        .otherwise(F.date_format("dt", "MM/dd/yy"))
    )
    parsed = F.date_format(parse_mixed("text"), "yyyy-MM-dd")
    return o.select("o_orderkey", text.alias("text")).withColumn("parsed", parsed)


def q_physical_features(spark, d):
    """Area, guarded ratios, density."""
    out = physical_features(raw_shipments(spark, d))
    return out.select(
        KEY, "Equipment_Area", "Weight_per_Area", "Value_per_Weight", "Value_per_Area",
        density("Equipment_Weight", "Equipment_Area").alias("Density"),
    )


def q_target_shift_log(spark, d):
    """M4 + J3/P10: shift from the labelled minimum, broadcast to each row, log1p(y + shift)."""
    return labelled_log(spark, d).select(KEY, "Target_Shift_Value", LOG)


def q_flag_codes(spark, d):
    """M7 (Yes/No/Missing → 1/0/−1) and M8 (True/False or Yes/No → 1/0)."""
    raw = raw_shipments(spark, d)
    filled = impute.constant_fill(raw, ["Rural_Hospital"])
    return filled.select(
        KEY,
        yes_no_code("Rural_Hospital").alias("Rural_Hospital"),
        true_false_code("Urgent_Shipping").alias("Urgent_Shipping"),
        true_false_code("CrossBorder_Shipping").alias("CrossBorder_Shipping"),
    )


def q_target_filters(spark, d):
    """Rows kept by the null, non-negative and valid-log filters."""
    raw = labelled(spark, d)
    nonnull = raw.dropna(subset=[TARGET])
    nonneg = nonnull.filter(F.col(TARGET) >= 0)
    logged = nonneg.withColumn("lg", F.log1p(TARGET))
    valid = logged.filter(F.col("lg").isNotNull() & ~F.isnan("lg"))
    back = valid.withColumn("err", F.abs(inverse_target("lg") - F.col(TARGET)))
    return (
        raw.agg(F.count(F.lit(1)).alias("n_rows"))
        .crossJoin(nonnull.agg(F.count(F.lit(1)).alias("n_non_null")))
        .crossJoin(nonneg.agg(F.count(F.lit(1)).alias("n_non_negative")))
        .crossJoin(back.agg(F.count(F.lit(1)).alias("n_valid_log"), (F.max("err") < 1e-6).alias("roundtrip_ok")))
    )


def q_preview(spark, d):
    """First and last five rows by key."""
    raw = raw_shipments(spark, d).select(KEY, TARGET)
    first = raw.orderBy(KEY).limit(5).withColumn("part", F.lit("head"))
    last = raw.orderBy(F.col(KEY).desc()).limit(5).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


def q_distinct_values(spark, d):
    """Sorted distinct values of a categorical column."""
    return raw_shipments(spark, d).select("Transport_Method").distinct().orderBy("Transport_Method")


def q_union_tagged(spark, d):
    """Tag origin, stack labelled and unlabelled rows by name, split on the flag."""
    train = labelled(spark, d).withColumn("is_train", F.lit(1))
    test = unlabelled(spark, d).withColumn("is_train", F.lit(0))
    both = train.unionByName(test, allowMissingColumns=True)
    return both.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(TARGET).alias("n_target"), F.countDistinct(KEY).alias("n_keys")
    )


def q_separate(spark, d):
    """Drop id/text columns, dispatch types, keep existing configured columns, separate."""
    raw = labelled(spark, d).drop("Supplier_Name", "Hospital_Location")
    _, nums = columns_by_type(raw, exclude=(KEY, TARGET))
    spec = FeatureSpec(KEY, tuple(existing(RAW_CATEGORICAL + ("Not_A_Column",), raw)), tuple(nums), TARGET)
    return separate(raw, spec.restricted_to(raw))


# ------------------------------------------------------------------ splits


def q_holdout_split(spark, d):
    """Hash hold-out, 20 % validation."""
    return raw_shipments(spark, d).select(KEY, split.holdout_flag(KEY, 0.2, SEED).alias("is_valid"))


def q_kfold(spark, d):
    """R2: shuffled 5-fold by key hash."""
    return split.kfold(raw_shipments(spark, d).select(KEY), KEY, 5, SEED)


def q_kfold_contiguous(spark, d):
    """Unshuffled 5-fold in key order (range-partitioned rank, no single-task window)."""
    return split.kfold_contiguous(raw_shipments(spark, d).select(KEY), KEY, 5)


# ------------------------------------------------------------------ profiling


def q_target_profile(spark, d):
    """A1: target min/max/mean/#negative and shift."""
    return profile.target_profile(labelled(spark, d), TARGET)


def q_moments(spark, d):
    """A2: moments of the target before and after the log transform."""
    return profile.moments(labelled_log(spark, d), [TARGET, LOG])


def q_skew_report(spark, d):
    """A3: skewness before/after log and the reduction."""
    df = labelled_log(spark, d)
    return profile.skew_report(df, TARGET, F.col(LOG))


def q_describe(spark, d):
    """A4: describe the raw numeric columns (exact quartiles)."""
    return profile.describe(raw_shipments(spark, d), list(RAW_NUMERIC))


def q_null_profile(spark, d):
    """A5: missing count/fraction of every raw column."""
    return profile.null_profile(raw_shipments(spark, d))


def q_cardinality(spark, d):
    """Distinct values per categorical (after address parsing)."""
    df = parse_location(raw_shipments(spark, d), "Hospital_Location")
    return profile.cardinality_profile(df, list(RAW_CATEGORICAL) + ["Location_State", "Location_Zip"])


def _corr(spark, d):
    df = engineered(spark, d)
    _, nums = columns_by_type(df, exclude=(KEY, TARGET, LOG, "Target_Shift_Value"))
    return profile.corr_with(df, nums, TARGET)


def q_corr_with_target(spark, d):
    """Pearson r of each numeric feature with the target, |r|, band; sorted by r."""
    return _corr(spark, d).orderBy("r")


def q_corr_top_bottom(spark, d):
    """K2: three most positive and three most negative correlations."""
    return profile.top_bottom(_corr(spark, d).filter(F.col("r").isNotNull()), "r", 3, tie="feature")


def q_histogram(spark, d):
    """50 equal-width bins of the log target."""
    return profile.histogram(labelled_log(spark, d), LOG, 50)


# ------------------------------------------------------------------ fill and encode


def q_categorical_fill(spark, d):
    """I1 + M7: categoricals NULL → 'Missing', Rural_Hospital → 1/0/−1."""
    raw = raw_shipments(spark, d)
    filled = impute.constant_fill(raw, list(RAW_CATEGORICAL))
    return filled.select(KEY, *[c for c in RAW_CATEGORICAL if c != "Rural_Hospital"],
                         yes_no_code("Rural_Hospital").alias("Rural_Hospital"))


def _label_cols():
    return [c for c in RAW_CATEGORICAL if c != "Rural_Hospital"] + ["Location_State", "Location_Zip"]


def q_label_dictionary(spark, d):
    """E1 fit on labelled ∪ unlabelled rows: sorted distinct values → codes."""
    raw = parse_location(raw_shipments(spark, d), "Hospital_Location")
    filled = impute.constant_fill(raw, _label_cols())
    return encode.fit_label_dictionary(filled, _label_cols())


def q_label_encoded(spark, d):
    """E1 + J2: every row's codes from the union-fitted dictionary."""
    raw = impute.constant_fill(parse_location(raw_shipments(spark, d), "Hospital_Location"), _label_cols())
    out, _ = encode.label_encode(raw, raw, _label_cols())
    return out.select(KEY, *_label_cols())


def q_label_encode_unseen(spark, d):
    """Dictionary fitted on the training split; unseen validation values → −1."""
    df = impute.constant_fill(engineered(spark, d), ["Location_State", "Location_Zip"])
    train, valid = split.holdout(df, KEY, 0.2, SEED)
    out, _ = encode.label_encode(train, valid, ["Location_State", "Location_Zip"], unseen=-1)
    return out.select(KEY, "Location_State", "Location_Zip")


def q_one_hot(spark, d):
    """One-hot fitted on train (alphabetical); position of the 1, −1 when unseen or NULL."""
    df = engineered(spark, d)
    train, valid = split.holdout(df, KEY, 0.2, SEED)
    model = encode.fit_one_hot(train, ["Location_State", "Hospital_Info"])
    out = model.transform(valid)
    return out.select(
        KEY,
        encode.one_hot_position("Location_State_ohe").alias("Location_State_pos"),
        encode.one_hot_position("Hospital_Info_ohe").alias("Hospital_Info_pos"),
    )


def q_target_encoding(spark, d):
    """E5 fit: per category count, mean and sigmoid-smoothed encoding of the log target (train split)."""
    train, _ = split.holdout(labelled_log(spark, d), KEY, 0.2, SEED)
    enc, _ = encode.fit_target_encoding(train, ["Transport_Method", "Hospital_Info"], LOG, smoothing=1.0, min_leaf=20)
    return enc


def q_target_encode_oof(spark, d):
    """Leak-free in-fold target encoding for two columns, all folds at once."""
    df = split.kfold(labelled_log(spark, d), KEY, 5, SEED)
    out = encode.target_encode_oof(df, ["Transport_Method", "Hospital_Info"], LOG, "fold", 2.0, 20, suffix="_te")
    return out.select(KEY, "fold", "Transport_Method_te", "Hospital_Info_te")


def q_target_encode_leakage(spark, d):
    """E7 vs E6: RMSE of the encoding used as a prediction, fitted on all rows vs out of fold."""
    df = split.kfold(labelled_log(spark, d), KEY, 5, SEED)
    leak = encode.target_encode(df, df, ["Hospital_Info"], LOG, 1.0, 20, suffix="_te")
    oof = encode.target_encode_oof(df, ["Hospital_Info"], LOG, "fold", 1.0, 20, suffix="_te")
    a = metrics.metrics(leak, LOG, "Hospital_Info_te", mape=False).withColumn("variant", F.lit("whole_train"))
    b = metrics.metrics(oof, LOG, "Hospital_Info_te", mape=False).withColumn("variant", F.lit("out_of_fold"))
    return a.unionByName(b).select("variant", "n", "rmse")


def q_encoder_store(spark, d):
    """Encoders fitted on train rows (target encoding, medians, scaler), stored, loaded and applied to validation rows."""
    df = labelled_log(spark, d).select(KEY, LOG, "Transport_Method", "Hospital_Info", "Equipment_Height", "Equipment_Value")
    train, valid = split.holdout(df, KEY, 0.2, SEED)
    path = scratch_path(spark, "encoder")
    fitted = FeatureEncoder.fit(train, ["Transport_Method", "Hospital_Info"], ["Equipment_Height", "Equipment_Value"], target=LOG, scale=True)
    fitted.save(path, spark)
    return FeatureEncoder.load(spark, path).transform(valid).drop(LOG)


def q_ordered_target_stat(spark, d):
    """Running mean of earlier rows' targets per category in a seeded order (two-level prefix sums)."""
    df = labelled(spark, d).select(KEY, "Hospital_Info", TARGET)
    out = encode.ordered_target_stat(df, "Hospital_Info", TARGET, KEY, seed=SEED, decimal_scale=3,
                                     out="Hospital_Info_ots")
    return out.select(KEY, "Hospital_Info_ots_n", "Hospital_Info_ots_sum", "Hospital_Info_ots")


def q_standard_scale(spark, d):
    """Standardise with train mean and population std, applied to validation rows."""
    df = labelled(spark, d)
    train, valid = split.holdout(df, KEY, 0.2, SEED)
    cols = ["Equipment_Value", "Equipment_Width"]
    stats = encode.fit_standard_scaler(train, cols)
    return encode.apply_standard_scaler(valid, stats, cols, suffix="_z").select(KEY, *[f"{c}_z" for c in cols])


def q_median_fill(spark, d):
    """Exact train medians filled into validation rows."""
    train, valid = split.holdout(labelled(spark, d), KEY, 0.2, SEED)
    cols = ["Supplier_Reliability", "Equipment_Height", "Base_Transport_Fee"]
    out, _ = impute.median_fill(train, valid, cols)
    return out.select(KEY, *cols)


def q_most_frequent(spark, d):
    """Most frequent value per categorical on train (ties → smallest)."""
    train, _ = split.holdout(engineered(spark, d), KEY, 0.2, SEED)
    return impute.most_frequent(train, ["Transport_Method", "Hospital_Info", "Location_State", "Installation_Service"])


def q_iterative_impute_one_predictor(spark, d):
    """I4 first round with one predictor: the incomplete column regressed on a complete one."""
    df = labelled(spark, d).filter(F.col("Equipment_Value").isNotNull()).select(
        KEY, "Equipment_Weight", "Equipment_Value"
    )
    out = impute.iterative_impute(df, ["Equipment_Weight", "Equipment_Value"], max_iter=1, checkpoint=False)
    return out.select(KEY, "Equipment_Weight")


def q_iterative_impute_two_predictors(spark, d):
    """I4 first round on the default path: the incomplete column regressed on two complete ones of very different scale."""
    cols = ["Supplier_Reliability", "Equipment_Value", "Equipment_Width"]
    df = labelled(spark, d).select(KEY, *cols).dropna(subset=cols[1:])
    return impute.iterative_impute(df, cols, max_iter=1).select(KEY, cols[0])


def q_iterative_impute(spark, d):
    """I4: chained-equation imputation of all numeric features (≤10 rounds, checkpointed)."""
    df = engineered(spark, d)
    _, nums = columns_by_type(df, exclude=(KEY, TARGET, LOG, "Target_Shift_Value"))
    out = impute.iterative_impute(df, nums)
    return out.select(KEY, *nums)


# ------------------------------------------------------------------ scores and blends (deterministic models)


def q_model_scores(spark, d):
    """RMSE, MAE, R² of each OOF model on the log target, best first."""
    return metrics.model_scores(baseline_preds(spark, d))


def q_regression_metrics(spark, d):
    """A10 + A11: metrics (with MAPE) on the original scale and original-scale RMSE of the line model."""
    p = baseline_preds(spark, d).filter(F.col("model") == "line")
    shift = labelled_log(spark, d).agg(F.first("Target_Shift_Value").alias("s"))
    df = p.crossJoin(F.broadcast(shift)).withColumns(
        {"y_orig": inverse_target("y", F.col("s")), "p_orig": inverse_target("pred", F.col("s"))}
    )
    m = metrics.metrics(df, "y_orig", "p_orig", mape=True)
    o = metrics.original_scale_rmse(df, "y", "pred", "s")
    return m.crossJoin(o)


def q_fold_mean_rmse(spark, d):
    """Mean and std of per-fold RMSE per model."""
    return metrics.fold_mean(baseline_preds(spark, d), "y", "pred", "fold", by=["model"])


def q_residuals(spark, d):
    """Residual beside the prediction for every OOF row and model."""
    return metrics.residuals(baseline_preds(spark, d), "y", "pred", keep=(KEY, "model"))


def q_align_predictions(spark, d):
    """Models side by side per key (pivot on a fixed model list)."""
    return align(baseline_preds(spark, d), KEY, models=BASELINE_MODELS)


def q_alignment_gaps(spark, d):
    """J1 check: keys missing a model, on predictions that lack one model for some keys."""
    from tabcast.operators.joins import alignment_gaps

    lost = (F.col("model") == "line") & (F.substring(F.md5(F.col(KEY).cast("string")), 1, 1) == "0")
    return alignment_gaps(baseline_preds(spark, d).filter(~lost), KEY)


def q_simple_average(spark, d):
    """Unweighted mean of the models per key."""
    return baseline_wide(spark, d).select(KEY, ensemble.average_wide(BASELINE_MODELS).alias("pred"), "y")


def _inverse_mse_weights(wide):
    scores = metrics.model_scores(ensemble.to_long(wide, BASELINE_MODELS, ("y",)))
    raw = scores.select("model", (F.lit(1.0) / (F.col("rmse") * F.col("rmse"))).alias("weight"))
    return ensemble.normalise_weights(raw)


def q_normalise_weights(spark, d):
    """Inverse-MSE weights normalised to sum 1."""
    return _inverse_mse_weights(baseline_wide(spark, d))


def q_blend(spark, d):
    """B5 + M6 + P11: weighted log-space blend, expm1 − shift, clamped at 0."""
    wide = baseline_wide(spark, d)
    return ensemble.blend_wide(wide, _inverse_mse_weights(wide), BASELINE_MODELS, (KEY,), shift="Target_Shift_Value", clamp=0.0)


def q_relative_improvement(spark, d):
    """% gain of simple and weighted blends over the best single model."""
    wide = baseline_wide(spark, d)
    blended = ensemble.blend_wide(wide, _inverse_mse_weights(wide), BASELINE_MODELS, ("y", *BASELINE_MODELS))
    blended = blended.withColumnRenamed("blend_log", "weighted").withColumn("simple_average", ensemble.average_wide(BASELINE_MODELS))
    scores = metrics.model_scores(ensemble.to_long(blended, (*BASELINE_MODELS, "simple_average", "weighted"), ("y",)))
    return metrics.relative_improvement(scores, ["simple_average", "weighted"])


def q_ensemble_difference(spark, d):
    """A15 between two ensembles: the means of the inverse-MSE blend and of a hand-weighted one, in original scale, and how far apart they are."""
    wide = baseline_wide(spark, d)
    ours = ensemble.blend_wide(wide, _inverse_mse_weights(wide), BASELINE_MODELS, (KEY, "Target_Shift_Value", *BASELINE_MODELS), shift="Target_Shift_Value", clamp=0.0)
    manual = spark.createDataFrame([(m, w) for m, w in zip(("mean", "group_mean", "line"), MANUAL_WEIGHT_SETS["w_64_1_35"])], "model string, weight double")
    both = ensemble.blend_wide(ours.withColumnRenamed("value", "ours").drop("blend_log"), manual, BASELINE_MODELS, ("ours",), shift="Target_Shift_Value", clamp=0.0)
    means = both.agg(F.avg("ours").alias("mean_weighted"), F.avg("value").alias("mean_manual"))
    return means.withColumn("abs_diff", F.abs(F.col("mean_weighted") - F.col("mean_manual")))


def q_prediction_summary(spark, d):
    """min/max/mean/median of the blended original-scale predictions."""
    return metrics.prediction_summary(q_blend(spark, d), "value")


def q_cross_model_means(spark, d):
    """Each model's mean prediction against the simple-average ensemble mean."""
    wide = baseline_wide(spark, d)
    per_model = ensemble.to_long(wide, BASELINE_MODELS, ()).groupBy("model").agg(F.avg("pred").alias("mean_pred"))
    ens = wide.agg(F.avg(ensemble.average_wide(BASELINE_MODELS)).alias("ensemble_mean"))
    return per_model.crossJoin(F.broadcast(ens)).withColumn(
        "abs_diff", F.abs(F.col("mean_pred") - F.col("ensemble_mean"))
    )


def q_weight_search(spark, d):
    """3000 random normalised weight vectors scored from the error Gram; best trial."""
    _, best = ensemble.weight_search(baseline_wide(spark, d), BASELINE_MODELS, n_trials=3000, seed=SEED)
    return best


def q_best_weights(spark, d):
    """B7's optimum: the weights of least RMSE on the simplex, beside the best of 3000 trials."""
    return ensemble.best_weights(baseline_wide(spark, d), BASELINE_MODELS, n_trials=3000, seed=SEED)


def q_manual_weight_grid(spark, d):
    """One blended, inverted output per hand-picked weight set."""
    wide = baseline_wide(spark, d)
    rows = [(s, m, float(w)) for s, ws in MANUAL_WEIGHT_SETS.items() for m, w in zip(("mean", "group_mean", "line"), ws)]
    weights = spark.createDataFrame(rows, "weight_set string, model string, weight double")
    return ensemble.blend_wide(wide, weights, BASELINE_MODELS, (KEY,), shift="Target_Shift_Value", set_col="weight_set")


def q_stacking_nonneg(spark, d):
    """Non-negative ridge stacking over α, weights rescaled to 1, RMSE per α."""
    return ensemble.stack_nonneg(baseline_wide(spark, d), list(BASELINE_MODELS))


# ------------------------------------------------------------------ KNN


def knn_frames(spark, d):
    emb = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("key"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        F.col("label").cast("double").alias("y"),
    )
    flag = split.holdout_flag("key", 0.2, SEED)
    return emb.filter(~flag), emb.filter(flag).drop("y")


def q_knn_embeddings(spark, d):
    """Exact 10-NN regression with 1/distance weights on the embeddings (20 % queries)."""
    train, query = knn_frames(spark, d)
    return knn.knn_regress(train, query, k=10, block_rows=4096)


# ------------------------------------------------------------------ sinks (write, read back)


def q_csv_roundtrip(spark, d):
    """Write the labelled rows as header CSV, read back with the explicit schema."""
    path = scratch_path(spark, "csv")
    sinks.write_table(labelled(spark, d), path, fmt="csv")
    return sinks.read_table(spark, path, fmt="csv")


def q_predictions_sink(spark, d):
    """S3: two-column id,value prediction file (header CSV), read back."""
    path = scratch_path(spark, "pred")
    sinks.write_predictions(q_blend(spark, d), KEY, "value", path)
    return sinks.read_predictions(spark, path, KEY, "value")


def q_dictionary_sink(spark, d):
    """Encoding dictionary written and read back."""
    path = scratch_path(spark, "dict")
    sinks.write_dictionary(q_label_dictionary(spark, d), path)
    return sinks.read_dictionary(spark, path)


def q_prediction_store(spark, d):
    """Log predictions stored partitioned by model; one model read back by partition filter."""
    path = scratch_path(spark, "store")
    sinks.save_predictions(baseline_preds(spark, d).select(KEY, "model", F.col("pred").alias("pred_log")), path)
    return sinks.load_predictions(spark, path, "line")


def q_weights_store(spark, d):
    """Weights written and read back."""
    path = scratch_path(spark, "weights")
    sinks.write_weights(_inverse_mse_weights(baseline_wide(spark, d)), path)
    return sinks.read_weights(spark, path)


def q_run_metadata(spark, d):
    """Shapes, column lists and shift of a preprocessing run, as (item, value) rows."""
    train = labelled(spark, d)
    test = unlabelled(spark, d)
    shift = profile.target_profile(train, TARGET).select("shift")
    return sinks.run_metadata(train, test, shift, engineered=["Location_State", "Location_Zip",
                                                                "Location_Is_Military", "Equipment_Area"])

