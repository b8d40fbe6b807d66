"""Reproducible splits by key hash.

A row's split depends only on md5(key ‖ seed), never on partitioning or row order, so
it is the same on any cluster size, after any repartition, and in the DuckDB oracle:
``('0x' || substr(md5(cast(key as varchar) || '42'), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabcast.session import cut_lineage


def key_hash(key: str | Column, seed: int = 42) -> Column:
    """32-bit unsigned integer from the first 8 hex digits of md5(key ‖ seed)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: str | Column, buckets: int, seed: int = 42) -> Column:
    return F.pmod(key_hash(key, seed), F.lit(buckets))


def holdout_flag(key: str | Column, frac: float, seed: int = 42) -> Column:
    """TRUE for the validation share (``frac`` in thousandths), FALSE for training rows."""
    return hash_bucket(key, 1000, seed) < F.lit(int(round(frac * 1000)))


def holdout(df: DataFrame, key: str, frac: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, validation) as two filters of one expression — no shuffle, no sampling state."""
    flag = holdout_flag(key, frac, seed)
    return df.filter(~flag), df.filter(flag)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """R2: shuffled K-fold — every row gets exactly one validation fold 0..k−1 (narrow, no shuffle)."""
    return df.withColumn(col, hash_bucket(key, k, seed).cast("int"))


def global_rank(df: DataFrame, key: str, partitions: int | None = None, col: str = "__rank") -> DataFrame:
    """0-based position of each row in key order, without funnelling rows into one task.

    Range-partition on the key, number rows inside each range, then add the running count of
    the earlier ranges (a table with one row per range partition, so its size is bounded).
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, key).withColumn("__pid", F.spark_partition_id())
    # written once: the counts and the join below must see the same range boundaries
    local = cut_lineage(
        ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__pid").orderBy(key)) - 1)
    )
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__offset",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("__pid", "__offset")
    out = local.join(F.broadcast(offsets), "__pid").withColumn(col, F.col("__local") + F.col("__offset"))
    return out.drop("__pid", "__local", "__offset")


def rank_within(df: DataFrame, group: str, order: str, partitions: int | None = None, col: str = "rank") -> DataFrame:
    """0-based position of each row within its ``group`` by ``order`` (rows assumed distinct),
    without a window that holds a whole group in one task: range-partition on (group, order),
    number rows inside each partition, add the counts of the same group in earlier partitions
    (a table of partitions × groups rows)."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, group, order).withColumn("__pid", F.spark_partition_id())
    local = cut_lineage(  # written once: counts and join must see the same range boundaries
        ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__pid", group).orderBy(order)) - 1)
    )
    counts = local.groupBy("__pid", group).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    out = local.join(F.broadcast(offsets), ["__pid", group]).withColumn(col, F.col("__local") + F.col("__off"))
    return out.drop("__pid", "__local", "__off")


def kfold_contiguous(df: DataFrame, key: str, k: int = 5, col: str = "fold") -> DataFrame:
    """Unshuffled K-fold in key order; the first n mod k folds hold one extra row (as ntile)."""
    ranked = global_rank(df, key)
    n = df.count()
    q, rem = divmod(n, k)
    big = rem * (q + 1)
    r = F.col("__rank")
    fold = F.when(r < big, F.floor(r / F.lit(q + 1))).otherwise(F.lit(rem) + F.floor((r - big) / F.lit(max(q, 1))))
    return ranked.withColumn(col, fold.cast("int")).drop("__rank")
