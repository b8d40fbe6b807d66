"""Arithmetic and conditional column functions (physical features, target transforms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Flag text → code maps used by the reference.
YES_NO_MISSING = {"Yes": 1, "No": 0, "Missing": -1}
TRUE_FALSE = {"True": 1, "False": 0, "true": 1, "false": 0, "Yes": 1, "No": 0}
# Fixed value: density denominator guard.
DENSITY_EPS = 1e-6


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(a: str | Column, b: str | Column) -> Column:
    """M2: a/b where b > 0, else 0 (b NULL → 0; a NULL with b > 0 → NULL); ±inf → 0."""
    a, b = _c(a), _c(b)
    r = F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return inf_to_zero(r)


def inf_to_zero(x: str | Column) -> Column:
    """Replace ±infinity by 0, keep NULL and finite values."""
    x = _c(x)
    return F.when(F.abs(x) == F.lit(float("inf")), F.lit(0.0)).otherwise(x)


def density(a: str | Column, area: str | Column) -> Column:
    """M3: a / (area + 1e-6), NULL instead of an error on a zero denominator."""
    return F.try_divide(_c(a), _c(area) + F.lit(DENSITY_EPS))


def physical_features(
    df: DataFrame,
    height: str = "Equipment_Height",
    width: str = "Equipment_Width",
    weight: str = "Equipment_Weight",
    value: str = "Equipment_Value",
) -> DataFrame:
    """M1+M2+P12: area and three guarded ratios in one projection."""
    area = F.col(height) * F.col(width)
    return df.withColumn("Equipment_Area", area).withColumns(
        {
            "Weight_per_Area": guarded_ratio(weight, "Equipment_Area"),
            "Value_per_Weight": guarded_ratio(value, weight),
            "Value_per_Area": guarded_ratio(value, "Equipment_Area"),
        }
    )


def shift_for(min_value: Column) -> Column:
    """M4 shift rule: |min| + 1 when the minimum is negative, else 0."""
    return F.when(min_value < 0, F.abs(min_value) + 1).otherwise(F.lit(0.0))


def shift_log(df: DataFrame, target: str, out: str | None = None, shift_col: str = "Target_Shift_Value") -> DataFrame:
    """M4 + J3: add the shift (one global aggregate, broadcast to every row) and log1p(y + shift).

    The aggregate is a single row, so the broadcast has a fixed size whatever the table size.
    """
    out = out or f"{target}_Log"
    shift = df.agg(shift_for(F.min(target)).alias(shift_col))
    joined = df.crossJoin(F.broadcast(shift))
    return joined.withColumn(out, F.log1p(F.col(target) + F.col(shift_col)))


def log_target(c: str | Column) -> Column:
    """M5: log1p(y) (after the non-negative filter)."""
    return F.log1p(_c(c))


def inverse_target(p: str | Column, shift: str | Column | float = 0.0) -> Column:
    """M6: expm1(p) − shift."""
    s = F.lit(shift) if isinstance(shift, (int, float)) else _c(shift)
    return F.expm1(_c(p)) - s


def clamp_min(x: str | Column, floor: float = 0.0) -> Column:
    """Values below ``floor`` become ``floor``."""
    return F.greatest(_c(x), F.lit(floor))


def map_codes(c: str | Column, mapping: dict) -> Column:
    """Map literal values to codes; values outside the map → NULL."""
    c = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(None).cast("int"))


def yes_no_code(c: str | Column) -> Column:
    """M7: Yes/No/Missing → 1/0/−1, other values → NULL."""
    return map_codes(c, YES_NO_MISSING)


def true_false_code(c: str | Column) -> Column:
    """M8: booleans and True/False (or Yes/No) text → 1/0, other values → NULL."""
    c = _c(c)
    return map_codes(c.cast("string"), TRUE_FALSE)
