"""Feature roles and type dispatch.

Spark has no row order, so every table carries its key through every step; the
``FeatureSpec`` names that key next to the categorical, numeric and target columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class FeatureSpec:
    key: str
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    target: str | None = None
    marker: str | None = None  # e.g. the train/test origin flag, never a feature
    extra: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> list[str]:
        return [*self.categorical, *self.numeric]

    def restricted_to(self, df: DataFrame) -> "FeatureSpec":
        """Keep only configured columns that exist in ``df``."""
        have = set(df.columns)
        return replace(
            self,
            categorical=tuple(c for c in self.categorical if c in have),
            numeric=tuple(c for c in self.numeric if c in have),
        )


def columns_by_type(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Split columns into (categorical = string, numeric = number types), minus ``exclude``."""
    cats, nums = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            cats.append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES):
            nums.append(f.name)
    return cats, nums


def existing(cols, df: DataFrame) -> list[str]:
    """Configured columns that are present in ``df`` (order kept)."""
    have = set(df.columns)
    return [c for c in cols if c in have]



def separate(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Key + features + target (no positional split: the key stays on every row)."""
    cols = [spec.key, *spec.features] + ([spec.target] if spec.target and spec.target in df.columns else [])
    return df.select(*cols)
