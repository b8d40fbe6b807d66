"""Nearest neighbours by inner product, through stable projections and kd-trees.

Candidates get one more coordinate that makes all their lengths equal; then the largest inner
product is the smallest Euclidean distance. A few random Gaussian projections shrink squared
distances to chi-square multiples of themselves. In each shard a kd-tree holds the projected points;
a query visits its leaves from the nearest on, verifies what lies in them by the true inner
product, and stops when the chi-square test says that a point farther out in the projection is
nearer than the k-th best found only with a small chance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabcast.llm.common import hash_bucket, materialise
from tabcast.llm.embedding_dedup import number_type, packed, unpacked, valid_vectors

PROJECTIONS = 8
#: A neighbour is missed with at most one less this chance, in each shard.
CONFIDENCE = 0.97
#: Candidates of a shard and queries of a block, about.
SHARD = 32_768
QUERIES = 512
LEAF = 96


def chi_square_quantile(p: float, degrees: int) -> float:
    """x at which the chi-square law of an even number of ``degrees`` reaches p."""
    import math

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))

    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def projection(size: int, count: int = PROJECTIONS, seed: int = 11):
    """Gaussian directions, the same in every task."""
    import numpy as np

    return np.random.Generator(np.random.PCG64([seed, size])).standard_normal((size + 1, count))


class ProjectedTree:
    """kd-tree over projected points: leaves with their bounds, points stored leaf by leaf."""

    def __init__(self, points, leaf: int = LEAF):
        import numpy as np

        self.order = np.empty(len(points), dtype=np.int64)
        self.starts, low, high, at = [], [], [], 0
        stack = [np.arange(len(points))]
        while stack:
            part = stack.pop()
            own = points[part]
            lo, hi = own.min(0), own.max(0)
            axis = int(np.argmax(hi - lo))
            if len(part) <= leaf or hi[axis] == lo[axis]:
                self.order[at : at + len(part)] = part
                self.starts.append(at)
                at += len(part)
                low.append(lo)
                high.append(hi)
                continue
            half = len(part) // 2
            split = np.argpartition(own[:, axis], half)
            stack += [part[split[half:]], part[split[:half]]]
        self.starts.append(at)
        self.low, self.high = np.array(low), np.array(high)

    def leaves(self, query):
        """(leaf, squared distance of the query to its bounds), nearest first."""
        import numpy as np

        d = np.maximum(self.low - query, 0) + np.maximum(query - self.high, 0)
        d = (d * d).sum(1)
        order = np.argsort(d, kind="stable")
        return order, d[order]


def _search(k: int, confidence: float, radius: float, kinds: tuple[str, str]):
    limit = chi_square_quantile(confidence, PROJECTIONS)

    def run(queries, rows):
        import numpy as np
        import pandas as pd

        out = []
        items = [int(kind[-1]) for kind in kinds]
        for size in sorted({len(v) // items[0] for v in queries["v"]}):
            q = queries[queries["v"].map(len) == size * items[0]].sort_values("id")
            c = rows[rows["v"].map(len) == size * items[1]].sort_values("id")
            if c.empty:
                continue
            x = unpacked(c["v"], kinds[1])
            ids = c["id"].to_numpy()
            lift = np.sqrt(np.maximum(radius * radius - (x * x).sum(1), 0))
            p = projection(size)
            tree = ProjectedTree(np.column_stack([x, lift]) @ p)
            x, ids = x[tree.order], ids[tree.order]
            y = unpacked(q["v"], kinds[0])
            for who, own, seen in zip(q["id"].to_numpy(), y, y @ p[:-1]):
                length = own @ own + radius * radius
                best, best_id, worst = np.empty(0), np.empty(0, np.int64), -np.inf
                for leaf, far in zip(*tree.leaves(seen)):
                    # Squared distance of the k-th best: a point as near has this chance to lie within ``far``.
                    if len(best) >= k and far > limit * max(length - 2 * worst, 0):
                        break
                    a, b = tree.starts[leaf], tree.starts[leaf + 1]
                    s, i = x[a:b] @ own, ids[a:b]
                    use = (s >= worst) & (i != who)
                    if not use.any():
                        continue
                    best, best_id = np.concatenate([best, s[use]]), np.concatenate([best_id, i[use]])
                    top = np.lexsort((best_id, -best))[:k]
                    best, best_id = best[top], best_id[top]
                    if len(best) >= k:
                        worst = best[-1]
                out.append(pd.DataFrame({"query_id": who, "vec_id": best_id, "score": best}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return run


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", confidence: float = CONFIDENCE
) -> DataFrame:
    """The ``k`` candidates of largest inner product found for each query: query_id, rank, vec_id, score.

    Both tables hold ids and vectors; a query's own id is no candidate of it. Scores are inner
    products in double precision; ties go to the smaller id. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows with null ids, take no part; queries meet only
    candidates of their length. Rows that repeat an id with the same vector count once. A query
    with fewer than k candidates gets them all; empty tables give no rows. Extra columns are ignored.

    Candidates are dealt to shards and queries to blocks; every block meets every shard.
    """
    own, asked = valid_vectors(rows, id_col, vector_col).distinct(), valid_vectors(queries, id_col, vector_col).distinct()
    kinds = (number_type(asked), number_type(own))
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    radius = own.agg(F.max(norm).alias("r")).first()["r"] or 0.0
    c, q = materialise(packed(own), "nearest-candidates"), materialise(packed(asked), "nearest-queries")
    shards, blocks = max(1, -(-c.count() // SHARD)), max(1, -(-q.count() // QUERIES))
    c = c.withColumn("shard", hash_bucket(F.col("id"), shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    q = q.withColumn("block", hash_bucket(F.col("id"), blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard"))
    found = found.applyInPandas(_search(k, confidence, radius, kinds), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
