"""The reference's nine preprocessing steps as one Spark plan.

load → target shift/log → tag + union → dates, address, drops, physical ratios → type
dispatch → categorical fill → binary map → label encoding → chained-equation imputation →
split on the origin flag. The key and the target travel with the rows (test rows get a
NULL target), so nothing is re-attached by position and no join is needed to bring the
target back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.functions.dates import date_features
from tabcast.functions.location import parse_location
from tabcast.functions.mathx import physical_features, yes_no_code
from tabcast.operators.encode import apply_label_dictionary, fit_label_dictionary
from tabcast.operators.impute import constant_fill, iterative_impute
from tabcast.operators.joins import one_row_broadcast
from tabcast.schema import columns_by_type
from tabcast.session import written

# Columns the reference drops, its binary column and its origin flag.
DROP_COLUMNS = ("Hospital_Location", "Supplier_Name")
BINARY_COLUMNS = ("Rural_Hospital",)
ORIGIN = "is_train"


@dataclass
class Preprocessed:
    train: DataFrame
    test: DataFrame
    dictionary: DataFrame
    categorical: list
    numeric: list
    shift: DataFrame


def features_before_encoding(train_raw: DataFrame, test_raw: DataFrame, key: str, target: str) -> DataFrame:
    """Steps 1–5: target shift/log on train, origin flag, union, dates, address, drops, ratios."""
    shift = train_raw.agg(
        F.when(F.min(target) < 0, F.abs(F.min(target)) + 1).otherwise(F.lit(0.0)).alias("Target_Shift_Value")
    )
    train = train_raw.withColumn(ORIGIN, F.lit(1))
    test = test_raw.withColumn(ORIGIN, F.lit(0))
    combined = train.unionByName(test, allowMissingColumns=True)
    combined = combined.crossJoin(one_row_broadcast(shift))
    combined = combined.withColumn(
        f"{target}_Log", F.when(F.col(ORIGIN) == 1, F.log1p(F.col(target) + F.col("Target_Shift_Value")))
    )
    combined = date_features(combined)
    combined = parse_location(combined, "Hospital_Location")
    combined = combined.drop(*DROP_COLUMNS)
    return physical_features(combined)


def preprocess(
    train_raw: DataFrame,
    test_raw: DataFrame,
    key: str,
    target: str,
    fit_on: str = "train",
    impute: bool = True,
    max_iter: int = 10,
) -> Preprocessed:
    """Full reference preprocessing. ``fit_on='union'`` reproduces the reference (encoders and
    imputer see train and test rows, quirk Q1); ``'train'`` fits both on train rows only."""
    combined = features_before_encoding(train_raw, test_raw, key, target)
    reserved = (key, ORIGIN, target, f"{target}_Log", "Target_Shift_Value")
    cats, nums = columns_by_type(combined, exclude=reserved)
    combined = constant_fill(combined, cats)
    for b in BINARY_COLUMNS:
        if b in combined.columns:
            combined = combined.withColumn(b, yes_no_code(b))
    label_cols = [c for c in cats if c not in BINARY_COLUMNS]
    # The dictionary, the imputer and both results read these rows.
    combined = written(combined, "combined")
    fit_df = combined if fit_on == "union" else combined.filter(F.col(ORIGIN) == 1)
    dictionary = fit_label_dictionary(fit_df, label_cols)
    combined = apply_label_dictionary(combined, dictionary, label_cols)
    if impute:
        fit_rows = None if fit_on == "union" else combined.filter(F.col(ORIGIN) == 1)
        combined = iterative_impute(combined, nums, max_iter=max_iter, fit_df=fit_rows)
    train = combined.filter(F.col(ORIGIN) == 1).drop(ORIGIN)
    test = combined.filter(F.col(ORIGIN) == 0).drop(ORIGIN, target, f"{target}_Log", "Target_Shift_Value")
    shift = train_raw.agg(
        F.when(F.min(target) < 0, F.abs(F.min(target)) + 1).otherwise(F.lit(0.0)).alias("Target_Shift_Value")
    )
    return Preprocessed(train, test, dictionary, cats, nums, shift)
