"""Chained-equation imputation by missing pattern (I4).

Whatever the rounds do, an imputed cell is an affine function of its row's observed cells, the same for
all rows that lack the same columns. So one pass adds up, for each missing pattern, the Gram
of its observed columns; all rounds then run on these small matrices, where each pattern keeps
the matrix that completes its rows. A second pass finds how far each round moved any row, which
decides where to stop, and a last narrow pass fills the cells. The number of passes depends neither on
the columns nor on the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.operators.solve import scaled_ridge_from_gram

#: More patterns than this are not summed up; ``impute.iterative_impute`` then goes column by column.
MAX_PATTERNS = 512
#: Rows that give the provisional centres and scales of the columns; any would do, these keep the sums' digits.
PROBE_ROWS = 1000


class TooManyPatterns(ValueError):
    """The table has more missing patterns than ``MAX_PATTERNS``."""


def _matrix(pdf: pd.DataFrame, cols) -> np.ndarray:
    return pdf[list(cols)].to_numpy(dtype=np.float64, na_value=np.nan)


def _patterns(x: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """(indices of the missing columns, rows that lack exactly these) of a block of rows."""
    missing = np.isnan(x)
    kinds, of_row = np.unique(missing, axis=0, return_inverse=True)
    of_row = of_row.reshape(-1)
    for i, kind in enumerate(kinds):
        yield tuple(np.flatnonzero(kind).tolist()), of_row == i


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x])


def _numeric(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols])


@dataclass
class PatternGrams:
    """Gram of [1, observed columns] of each missing pattern, in columns moved by ``centre`` and divided by ``scale``."""

    cols: list[str]
    centre: np.ndarray
    scale: np.ndarray
    grams: dict[tuple[int, ...], np.ndarray]
    largest: float

    @classmethod
    def of(cls, df: DataFrame, cols, max_patterns: int = MAX_PATTERNS) -> PatternGrams:
        """One pass; a task emits one matrix per pattern, which the executors add up."""
        cols, d = list(cols), len(cols) + 1
        x = _numeric(df, cols)
        probe = _matrix(x.limit(PROBE_ROWS).toPandas(), cols)
        seen = [v[np.isfinite(v)] for v in probe.T]
        centre = np.array([v.mean() if len(v) else 0.0 for v in seen])
        scale = np.array([v.std() if len(v) and v.std() > 0 else 1.0 for v in seen])

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found, top = {}, np.zeros(d)
            for pdf in batches:
                raw = _matrix(pdf, cols)
                if not len(raw):
                    continue
                top[1:] = np.fmax(top[1:], np.fmax.reduce(np.abs(raw), axis=0, initial=0.0))
                for missing, rows in _patterns(raw):
                    z = _with_one(np.nan_to_num((raw[rows] - centre) / scale, nan=0.0))
                    found[missing] = found.get(missing, 0.0) + z.T @ z
                if len(found) > max_patterns:
                    # Enough to tell that there are too many.
                    break
            names = [",".join(map(str, m)) for m in found]
            if names:
                yield pd.DataFrame({"pattern": names, "g": [g.ravel() for g in found.values()], "top": [np.pad(top, (0, d * d - d))] * len(names)})

        parts = x.mapInPandas(sums, "pattern string, g array<double>, top array<double>")
        cells = parts.select("pattern", F.posexplode(F.arrays_zip("g", "top")).alias("pos", "v"))
        added = cells.groupBy("pattern", "pos").agg(F.sum("v.g").alias("g"), F.max("v.top").alias("top"))
        # One row per pattern and matrix cell; a bounded number of patterns comes to the driver.
        kinds = added.where("pos = 0").select("pattern").limit(max_patterns + 1)
        added = added.persist()
        try:
            if kinds.count() > max_patterns:
                raise TooManyPatterns(f"more than {max_patterns} missing patterns")
            table = added.toPandas()
        finally:
            added.unpersist()
        grams, largest = {}, 0.0
        for name, part in table.groupby("pattern"):
            g = np.zeros(d * d)
            g[part["pos"].to_numpy()] = part["g"].to_numpy()
            grams[tuple(int(i) for i in name.split(",")) if name else ()] = g.reshape(d, d)
            largest = max(largest, float(part["top"].max()))
        return cls(cols, centre, scale, grams, largest)

    def completed(self, maps: dict[tuple[int, ...], np.ndarray]) -> dict[tuple[int, ...], np.ndarray]:
        """The Grams of the completed rows, if ``maps[p]`` completes the rows of pattern p."""
        return {p: maps[p] @ g @ maps[p].T for p, g in self.grams.items()}


@dataclass
class ChainedImputer:
    """Fitted chained equations: means of the columns and the regressions of all rounds, in order.

    Replaying the regressions gives the affine map of any missing pattern, also of one that the
    fitted rows did not have. A column without any value stays missing and predicts nothing.
    """

    cols: list[str]
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    steps: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    rounds: int = 0

    def _start(self, missing: tuple[int, ...]) -> np.ndarray:
        """[1, columns] of a row before the first round as a map of [1, observed columns with 0 for missing ones]."""
        a = np.eye(len(self.cols) + 1)
        for c in missing:
            a[c + 1] = 0.0
            a[c + 1, 0] = self.means[c]
        return a

    def maps(self, missing: tuple[int, ...], rounds: int | None = None) -> list[np.ndarray]:
        """The map that completes a row of this pattern before the first and after each round."""
        out, a, at = [self._start(missing)], self._start(missing), 1
        for r, c, w in self.steps:
            if rounds is not None and r > rounds:
                break
            if r > at:
                out.append(a.copy())
                at = r
            if c in missing:
                a[c + 1] = w @ a
        out.append(a.copy())
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the missing cells of ``cols`` filled, in one narrow pass; observed cells and other columns stay as they are."""
        cols, rounds = self.cols, self.rounds
        lacking = sorted({c for _, c, _ in self.steps})
        if not lacking:
            return df
        names = [cols[c] for c in lacking]
        me = self
        known: dict[tuple[int, ...], np.ndarray] = {}

        @F.pandas_udf(", ".join(f"c{i} double" for i in range(len(names))))
        def fill(x: pd.DataFrame) -> pd.DataFrame:
            raw = x.to_numpy(dtype=np.float64, na_value=np.nan)
            out = raw.copy()
            for missing, rows in _patterns(raw):
                gaps = [c for c in missing if c in lacking]
                if not gaps:
                    continue
                if missing not in known:
                    known[missing] = me.maps(missing, rounds)[-1]
                z = _with_one(np.nan_to_num((raw[rows] - me.centre) / me.scale, nan=0.0))
                done = z @ known[missing].T[:, [c + 1 for c in gaps]] * me.scale[gaps] + me.centre[gaps]
                for i, c in enumerate(gaps):
                    out[rows, c] = done[:, i]
            return pd.DataFrame({f"c{i}": out[:, c] for i, c in enumerate(lacking)})

        filled = df.withColumn("__filled", fill(F.struct(*[F.col(c).cast("double").alias(c) for c in cols])))
        # Observed cells are taken from the input, to the last bit.
        seen = {n: F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double")) for n in names}
        return filled.withColumns({n: F.when(seen[n], F.col(n).cast("double")).otherwise(F.col(f"__filled.c{i}")) for i, n in enumerate(names)}).drop("__filled")


def fit_chained(df: DataFrame, cols, max_iter: int = 10, tol: float = 1e-3, ridge: float = 1e-12, max_patterns: int = MAX_PATTERNS) -> ChainedImputer:
    """Fit chained equations on the rows of ``df``; raises ``TooManyPatterns`` beyond ``max_patterns``.

    Start from the column means; then, round-robin from the least to the most incomplete column,
    regress each incomplete column on all others over the rows that have it, on columns centred and
    scaled (``ridge`` is relative to their unit variance), and replace its missing cells by the
    prediction. It stops after the round that moved no row by more than ``tol`` times the largest
    magnitude (sum over the row's cells), after ``max_iter`` at the latest. NULL and NaN are missing.
    """
    stats = PatternGrams.of(df, cols, max_patterns)
    cols, d = stats.cols, len(stats.cols)
    n = {c: sum(g[0, 0] for p, g in stats.grams.items() if c in p) for c in range(d)}
    rows = {c: sum(g[0, 0] for p, g in stats.grams.items() if c not in p) for c in range(d)}
    total = {c: sum(g[0, c + 1] for p, g in stats.grams.items() if c not in p) for c in range(d)}
    bare = [c for c in range(d) if not rows[c]]
    means = np.array([total[c] / rows[c] if rows[c] else 0.0 for c in range(d)])
    fitted = ChainedImputer(cols, stats.centre, stats.scale, means)
    order = sorted([c for c in range(d) if n[c] and c not in bare], key=lambda c: (n[c], c))
    if not order:
        return fitted
    maps = {p: fitted._start(p) for p in stats.grams}
    grams = stats.completed(maps)
    for r in range(1, max_iter + 1):
        for c in order:
            g = sum(x for p, x in grams.items() if c not in p)
            others = [0, *[o + 1 for o in range(d) if o != c and o not in bare]]
            w = np.zeros(d + 1)
            w[others] = scaled_ridge_from_gram(g[np.ix_(others, others)], g[others, c + 1], ridge)
            fitted.steps.append((r, c, w))
            for p in grams:
                if c in p:
                    maps[p][c + 1] = w @ maps[p]
                    grams[p] = maps[p] @ stats.grams[p] @ maps[p].T
    moved = _largest_moves(df, fitted, max_iter)
    bound = tol * max(stats.largest, 1e-12)
    fitted.rounds = next((r for r, m in enumerate(moved, 1) if m < bound), max_iter)
    fitted.steps = [s for s in fitted.steps if s[0] <= fitted.rounds]
    return fitted


def _largest_moves(df: DataFrame, fitted: ChainedImputer, rounds: int) -> list[float]:
    """For each round the largest sum over a row of what its imputed cells moved, in raw units; one pass."""
    cols = fitted.cols

    def moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        most, known = np.zeros(rounds), {}
        for pdf in batches:
            raw = _matrix(pdf, cols)
            if not len(raw):
                continue
            for missing, rows in _patterns(raw):
                if not missing:
                    continue
                if missing not in known:
                    steps = fitted.maps(missing)
                    known[missing] = [(b - a)[[c + 1 for c in missing]] * fitted.scale[list(missing)][:, None] for a, b in zip(steps, steps[1:])]
                z = _with_one(np.nan_to_num((raw[rows] - fitted.centre) / fitted.scale, nan=0.0))
                for r, step in enumerate(known[missing]):
                    most[r] = max(most[r], np.abs(z @ step.T).sum(axis=1).max())
        yield pd.DataFrame({"r": np.arange(rounds), "m": most})

    found = _numeric(df, cols).mapInPandas(moves, "r int, m double").groupBy("r").agg(F.max("m").alias("m")).collect()
    most = {r["r"]: r["m"] for r in found}
    return [most.get(r, 0.0) for r in range(rounds)]
