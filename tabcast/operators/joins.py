"""Joins of a large keyed table with small fitted state.

Fitted state (dictionaries, encodings, weights) is small *per category*, not per row, but
its size still grows with cardinality. ``bounded_broadcast`` adds up its bytes first and only
broadcasts under a bound; above it the join stays a shuffle join (AQE may still
switch it at run time from measured sizes, and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of values, before the overhead of a hash table.
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20


def materialise(small: DataFrame) -> DataFrame:
    """Write fitted state to the shared checkpoint folder and return it with a one-node lineage.

    Fitted tables are derived from the very rows they are joined back into; without this cut
    every join would carry (and Catalyst would re-analyse) a full copy of the upstream plan.
    """
    from tabcast.session import cut_lineage

    return cut_lineage(small)


def bounded_broadcast(small: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Materialise fitted state, then broadcast it only when its values take at most ``max_bytes``;
    above that the join stays a shuffle join."""
    small = materialise(small)
    size = [F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in small.dtypes]
    total = small.agg(F.sum(sum(size, F.lit(16)))).first()[0] or 0
    return F.broadcast(small) if total <= max_bytes else small


def one_row_broadcast(agg_row: DataFrame) -> DataFrame:
    """A global aggregate has exactly one row: broadcasting it is always size-safe."""
    return F.broadcast(agg_row)


def align(preds: DataFrame, key: str, model_col: str = "model", value_col: str = "pred", models=None) -> DataFrame:
    """Put each model's prediction side by side per key (one shuffle: group by key, pivot model).

    ``models`` fixes the pivot values (and so the output schema) without an extra distinct job.
    """
    grouped = preds.groupBy(key)
    pivoted = grouped.pivot(model_col, list(models) if models is not None else None)
    return pivoted.agg(F.first(value_col))


def alignment_gaps(preds: DataFrame, key: str, model_col: str = "model") -> DataFrame:
    """J1 check: keys that some model lacks (must be empty). Counts per key are pre-aggregated."""
    n_models = preds.select(model_col).distinct().count()
    per_key = preds.groupBy(key).agg(F.countDistinct(model_col).alias("n_models"))
    return per_key.filter(F.col("n_models") != F.lit(n_models))
