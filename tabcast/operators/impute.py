"""Missing-value imputation (I1–I4) and exact quantiles.

Exact quantiles never bring values of a column together: a mergeable sketch of bounded size names
two values around each wanted rank, one pass counts what lies below, on and between them, and the
next round looks only between them. A rank that falls on one of the two values is answered, however
many rows hold that value, so ties end the search instead of stalling it.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.operators.chained import TooManyPatterns, fit_chained
from tabcast.operators.solve import gram, scaled_ridge_from_gram
from tabcast.session import cut_lineage, written

MISSING = "Missing"


def constant_fill(df: DataFrame, cols, value: str = MISSING) -> DataFrame:
    """NULL → a constant (categoricals → 'Missing')."""
    return df.fillna({c: value for c in cols})


def _rank_positions(n: int, q: float) -> tuple[int, int, float]:
    """Linear interpolation between order statistics at position (n−1)·q (0-based)."""
    pos = (n - 1) * q
    lo = int(math.floor(pos))
    return lo, min(lo + 1, n - 1), pos - lo


def exact_quantiles(df: DataFrame, cols, q=0.5, accuracy: int = 10000, again: bool = False) -> dict:
    """Exact quantiles (linear interpolation, = DuckDB quantile_cont / pandas) of several columns.

    ``q`` is one fraction (result: column → value) or several (result: fraction → column → value);
    all of them share every pass. A column without values has None. Each round removes at least
    the two named values from what is left and, by the sketch, all but about ``2 / accuracy`` of the
    rows, so a few rounds of two passes do; only counts and named values reach the driver. ``again``: every pass
    reads ``df``, as for rows that are written; else its columns are held meanwhile.
    """
    cols, fractions = list(cols), [q] if isinstance(q, (int, float)) else list(q)
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    base = base if again else base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = base.agg(*[F.count(c).alias(c) for c in cols]).first().asDict() if cols else {}
        ranks = {(c, f): _rank_positions(counts[c], f) for c in cols if counts[c] for f in fractions}
        found = _order_statistics(base, {(c, lo) for (c, _), (lo, _, _) in ranks.items()}, counts, accuracy)
        # The next order statistic: the same value if more rows hold it, else the smallest one above.
        wanted = {(c, lo) for (c, _), (lo, hi, part) in ranks.items() if part and hi > lo and found[c, lo][1] <= hi}
        above = {}
        if wanted:
            keys = sorted(wanted)
            row = base.agg(*[F.min(F.when(F.col(c) > found[c, r][0], F.col(c))).alias(f"v{i}") for i, (c, r) in enumerate(keys)]).first()
            above = {k: row[f"v{i}"] for i, k in enumerate(keys)}
        result = {f: dict.fromkeys(cols) for f in fractions}
        for (c, f), (lo, _, part) in ranks.items():
            value = found[c, lo][0]
            result[f][c] = value + (above.get((c, lo), value) - value) * part
        return result[fractions[0]] if isinstance(q, (int, float)) else result
    finally:
        if not again:
            base.unpersist()


def _order_statistics(base: DataFrame, targets, counts: dict, accuracy: int) -> dict:
    """(column, 0-based rank) → (value, number of values up to and including it)."""
    # What is left of each target: values strictly between two bounds, and how many lie at or below the lower one.
    left = {t: (None, None, 0, counts[t[0]]) for t in targets}
    found = {}
    while left:
        keys = sorted(left)
        inside = {}
        for c, r in keys:
            low, high, _, _ = left[c, r]
            cond = F.col(c).isNotNull()
            if low is not None:
                cond &= F.col(c) > low
            if high is not None:
                cond &= F.col(c) < high
            inside[c, r] = cond
        # Ranks that are looked for between the same bounds share one sketch.
        ends, fractions = {}, {}
        for c, r in keys:
            low, high, below, n = left[c, r]
            eps = 0.0 if n <= accuracy // 2 else 1.0 / accuracy
            at = (r - below + 0.5) / n
            ends[c, r] = (max(at - eps, 0.0), min(at + eps, 1.0))
            fractions.setdefault((c, low, high), set()).update(ends[c, r])
        asked = {bounds: sorted(f) for bounds, f in fractions.items()}
        some = {(c, *left[c, r][:2]): inside[c, r] for c, r in keys}
        sketch = base.agg(*[F.percentile_approx(F.when(some[b], F.col(b[0])), f, accuracy).alias(f"p{i}") for i, (b, f) in enumerate(asked.items())]).first()
        answer = {(b, f): v for i, (b, fs) in enumerate(asked.items()) for f, v in zip(fs, sketch[f"p{i}"])}
        named = {(c, r): [answer[(c, *left[c, r][:2]), f] for f in ends[c, r]] for c, r in keys}
        aggs = []
        for i, (c, r) in enumerate(keys):
            lo, hi = named[c, r]
            v = F.col(c)
            for k, cond in (("a", v < lo), ("b", v == lo), ("c", (v > lo) & (v < hi)), ("d", (v == hi) & F.lit(hi > lo))):
                aggs.append(F.count(F.when(inside[c, r] & cond, 1)).alias(f"{k}{i}"))
        stat = base.agg(*aggs).first()
        now = {}
        for i, (c, r) in enumerate(keys):
            low, high, below, n = left[c, r]
            lo, hi = named[c, r]
            for k, value, bounds in (("a", None, (low, lo)), ("b", lo, None), ("c", None, (lo, hi)), ("d", hi, None)):
                size = stat[f"{k}{i}"]
                if r < below + size:
                    break
                below += size
            else:
                value, bounds, size = None, (hi, high), n - (below - left[c, r][2])
            if bounds is None:
                found[c, r] = (value, below + size)
            else:
                now[c, r] = (*bounds, below, size)
        left = now
    return found


def median_fill(fit_df: DataFrame, apply_df: DataFrame, cols, again: bool = False) -> tuple[DataFrame, dict]:
    """Exact median fitted on ``fit_df`` (train), applied to ``apply_df``; columns without NULLs there need none.
    ``again``: as for ``exact_quantiles``."""
    cols = list(cols)
    missing = apply_df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first().asDict() if cols else {}
    med = exact_quantiles(fit_df, [c for c in cols if missing[c]], 0.5, again=again)
    return apply_df.fillna({c: v for c, v in med.items() if v is not None}), med


def most_frequent(fit_df: DataFrame, cols, numeric: bool = False) -> DataFrame:
    """I3 fit: (column, value, n) of the most frequent value; ties → smallest value.

    Counts are a partial aggregate (map-side combine), so a hot value never lands whole in
    one task; the arg-max is another aggregate over one row per distinct value.
    """
    vt = "double" if numeric else "string"
    long = fit_df.select(*[F.col(c).cast(vt).alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by(F.struct((-F.col("n")).alias("neg_n"), "value"),
                                                  F.struct((-F.col("n")).alias("neg_n"), "value")).alias("b"))
    return best.select("column", F.col("b.value").alias("value"), (-F.col("b.neg_n")).alias("n"))


def iterative_impute(
    df: DataFrame,
    cols,
    max_iter: int = 10,
    tol: float = 1e-3,
    ridge: float = 1e-12,
    checkpoint: bool = True,
    fit_df: DataFrame | None = None,
) -> DataFrame:
    """I4: chained-equation imputation of the numeric ``cols``, fitted on ``fit_df`` (default: ``df`` itself).

    Start from the column means; then, round-robin from the least to the most incomplete
    column, regress each incomplete column on all others over its observed rows and replace
    its missing cells by the prediction. Stops when no row moved by ``tol`` times the largest observed
    magnitude. Observed cells are never changed; ``fit_df`` is read in full, ``df`` only when its rows are used.

    The rounds run on the Grams of the missing patterns (``chained``): two passes whatever the number of
    columns and rounds. With more patterns than it holds, and no ``fit_df`` of its own, it goes column by column.
    ``checkpoint``: write the numeric columns once, so that both passes read them from there.
    """
    cols = list(cols)
    source = df if fit_df is None else fit_df
    source = source.select(*cols)
    if checkpoint and cols:
        source = written(source, "chained-fit")
    try:
        return fit_chained(source, cols, max_iter, tol, ridge).transform(df) if cols else df
    except TooManyPatterns:
        if fit_df is not None:
            raise
        return impute_by_passes(df, cols, max_iter, tol, ridge, checkpoint)


def impute_by_passes(
    df: DataFrame,
    cols,
    max_iter: int = 10,
    tol: float = 1e-3,
    ridge: float = 1e-12,
    checkpoint: bool = True,
) -> DataFrame:
    """``iterative_impute`` column by column: one Gram aggregate per incomplete column and round.

    For tables with more missing patterns than ``chained.MAX_PATTERNS``. Rows never leave the
    executors; each round is checkpointed to the shared checkpoint folder. A column without any value is
    left out.
    """
    cols = [c for c, n in df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict().items() if n] if cols else []
    if not cols:
        return df
    stats = df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nm") for c in cols],
        *[F.avg(c).alias(f"{c}__mean") for c in cols],
        *[F.max(F.abs(F.col(c))).alias(f"{c}__amax") for c in cols],
    ).first()
    incomplete = sorted([c for c in cols if stats[f"{c}__nm"] > 0], key=lambda c: (stats[f"{c}__nm"], cols.index(c)))
    if not incomplete:
        return df
    scale = max([stats[f"{c}__amax"] or 0.0 for c in cols] + [1e-12])
    cur = df.withColumns({f"__obs_{c}": F.col(c).isNotNull() for c in incomplete})
    cur = cur.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(stats[f"{c}__mean"])) for c in incomplete})
    if checkpoint:
        cur = cut_lineage(cur)
    cached = older = None  # at most two generations are kept in memory
    for _ in range(max_iter):
        cur = cur.withColumns({f"__prev_{c}": F.col(c) for c in incomplete})
        for c in incomplete:
            others = [o for o in cols if o != c]
            G, xy, _, _ = gram(cur, others, c, where=F.col(f"__obs_{c}"))  # fills the cache of ``cur``
            if older is not None:
                older.unpersist()
            w = scaled_ridge_from_gram(G, xy, ridge)
            pred = F.lit(float(w[0]))
            for wi, o in zip(w[1:], others):
                pred = pred + F.lit(float(wi)) * F.col(o)
            # Each update is cached, so later plans start from it instead of inlining every earlier
            # update, which would grow the expressions exponentially in the number of columns.
            nxt = cur.withColumn(c, F.when(F.col(f"__obs_{c}"), F.col(c)).otherwise(pred)).persist(StorageLevel.MEMORY_AND_DISK)
            older, cached = cached, nxt
            cur = nxt
        # infinity norm of the change matrix = largest row sum of |new − old|
        row_change = sum((F.abs(F.col(c) - F.col(f"__prev_{c}")) for c in incomplete), F.lit(0.0))
        change = cur.agg(F.max(row_change).alias("m")).first()["m"] or 0.0
        cur = cur.drop(*[f"__prev_{c}" for c in incomplete])
        if older is not None:
            older.unpersist()
            older = None
        if checkpoint:
            cur = cut_lineage(cur)
            cached.unpersist()
            cached = None
        if change < tol * scale:
            break
    return cur.drop(*[f"__obs_{c}" for c in incomplete])
