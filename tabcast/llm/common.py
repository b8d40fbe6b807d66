"""Helpers shared by the operators of this subpackage: written stages, split ranks, components.

Nothing here depends on the input's size: the number of split buckets is a parameter, and
whatever reaches the driver is a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabcast.session import release, written
from tabcast.sources.tables import table

#: Fixed by the contracts: a word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a hot key that one task takes; at least and at most so many tasks share a key.
ROWS_A_SHARE, SHARES = 100_000, (8, 4096)

__all__ = ["WORD", "components", "hash_bucket", "materialise", "release", "shares", "split_rank", "spread_join", "table"]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    The plan behind the result is one scan, so a lost executor never repeats what came before.
    """
    return written(df, name)


def hash_bucket(key: Column, buckets: int, seed: int = 7) -> Column:
    """A bucket from 0 to ``buckets - 1`` by a hash of ``key`` (null has a bucket too)."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)).cast("int")


def spread_join(big: DataFrame, small: DataFrame, on: list[str], hot: DataFrame, salt: str, shares: int) -> DataFrame:
    """``big`` left join ``small`` (unique by ``on``); rows with a key in ``hot`` are dealt over ``shares`` tasks.

    ``hot`` has a bounded number of keys and is broadcast; only their rows of ``small`` are repeated.
    """
    marked = F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))
    share = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt), F.lit(shares))).otherwise(F.lit(0)).cast("int")
    all_shares = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(shares - 1))).otherwise(F.array(F.lit(0)))
    left = big.join(marked, on, "left").withColumn("_share", share).drop("_hot")
    right = small.join(marked, on, "left").withColumn("_share", F.explode(all_shares)).drop("_hot")
    return left.join(right, [*on, "_share"], "left").drop("_share")


def shares(rows: int) -> int:
    """In how many tasks a hot key's rows are dealt, among so many rows."""
    return max(SHARES[0], min(SHARES[1], rows // ROWS_A_SHARE))


def split_rank(df: DataFrame, by: list[str], bucket: str, order: list[Column], rank: str) -> DataFrame:
    """Number the rows of each ``by`` group from 0 without ever holding a group in one task.

    Rows are numbered inside (group, bucket); the counts of the earlier buckets, one row per
    (group, bucket), are added. ``bucket`` must be a small int column that splits every group evenly.
    """
    from pyspark.sql import Window

    counts = df.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *(F.col(c).alias(f"_s_{c}") for c in [*by, bucket]), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*by, bucket).orderBy(*order)
    numbered = df.withColumn("_rn", F.row_number().over(inside) - 1)
    on = [numbered[c].eqNullSafe(starts[f"_s_{c}"]) for c in [*by, bucket]]
    return numbered.join(starts, on).select(*df.columns, (F.col("_start") + F.col("_rn")).cast("long").alias(rank))


def _same_edges(df: DataFrame) -> tuple:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` holds pairs of long ids. Returns (node, root): every node with an edge to another
    node and the smallest id it reaches, itself included. Every round is written; only a count
    and a checksum come to the driver. Null ids and loops link nothing.
    """
    e = (
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    e = materialise(e, "cc-edges")
    seen = _same_edges(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "cc-large")
        release(e)
        least2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least2, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least2.select("a", F.col("m").alias("b")))
            .distinct()
        )
        e = materialise(small, "cc-small")
        release(large)
        now = _same_edges(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
