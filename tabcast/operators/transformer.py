"""Fitted feature encoders that are stored beside a model.

``FeatureEncoder`` holds what a model's features were made with: a label dictionary or target
encodings of the categoricals, fills of the numerics (exact medians or chained equations) and a
scaler. It is fitted on training rows, applied to any rows, and saved as Parquet tables in one folder,
so that a stream scorer or a later session makes the same features to the last bit.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.operators.chained import ChainedImputer, fit_chained
from tabcast.operators.encode import apply_label_dictionary, apply_target_encoding, fit_label_dictionary, fit_target_encoding
from tabcast.operators.impute import MISSING, constant_fill, exact_quantiles
from tabcast.session import written


@dataclass
class FeatureEncoder:
    """Categoricals and numerics of a table as model features; see ``fit``."""

    cats: list[str]
    nums: list[str]
    labels: DataFrame | None = None
    targets: DataFrame | None = None
    prior: float | None = None
    medians: dict[str, float] = field(default_factory=dict)
    chained: ChainedImputer | None = None
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cats, nums, target: str | None = None, smoothing: float = 1.0, min_leaf: int = 20, fill: str = "median", scale: bool = False) -> FeatureEncoder:
        """Fit on the rows of ``df``.

        Categoricals: NULL is a category; with ``target`` their smoothed target encoding (E5; unseen: the prior),
        without it label codes (E2; unseen: −1). Numerics: ``fill`` 'median' (exact), 'chained' (I4) or 'none'; with
        ``scale`` they are then divided by their population standard deviation around the mean (E9).
        """
        me = cls(list(cats), list(nums))
        filled = constant_fill(df, me.cats)
        if me.cats and target is None:
            me.labels = written(fit_label_dictionary(filled, me.cats), "encoder-labels")
        elif me.cats:
            encoding, prior = fit_target_encoding(filled, me.cats, target, smoothing, min_leaf)
            me.targets, me.prior = written(encoding, "encoder-targets"), float(prior.first()["prior"])
        if me.nums and fill == "median":
            me.medians = {c: v for c, v in exact_quantiles(df, me.nums, 0.5).items() if v is not None}
        elif me.nums and fill == "chained":
            me.chained = fit_chained(df.select(*me.nums), me.nums)
        elif fill not in ("median", "chained", "none"):
            raise ValueError(f"fill must be median, chained or none, not {fill}")
        if scale and me.nums:
            row = me._filled(df).agg(*[F.avg(c).alias(f"m_{c}") for c in me.nums], *[F.stddev_pop(c).alias(f"s_{c}") for c in me.nums]).first()
            me.scale = {c: (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"] or 1.0)) for c in me.nums}
        return me

    def _filled(self, df: DataFrame) -> DataFrame:
        if self.chained is not None:
            df = self.chained.transform(df)
        return df.fillna(self.medians) if self.medians else df

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its categoricals and numerics replaced by features; all other columns stay."""
        out = self._filled(constant_fill(df, self.cats))
        if self.labels is not None:
            out = apply_label_dictionary(out, self.labels, self.cats, unseen=-1)
        if self.targets is not None:
            prior = df.sparkSession.createDataFrame([(self.prior,)], "prior double")
            out = apply_target_encoding(out, self.targets, prior, self.cats)
        return out.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.scale.items()})

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the encoder to ``path``, over what lies there."""
        c = self.chained
        state = {"cats": self.cats, "nums": self.nums, "prior": self.prior, "medians": self.medians, "scale": self.scale, "missing": MISSING}
        if c is not None:
            arrays = {"centre": c.centre, "scale": c.scale, "means": c.means}
            steps = [(r, i, w.tolist()) for r, i, w in c.steps]
            state["chained"] = {"cols": c.cols, "steps": steps, "rounds": c.rounds} | {n: v.tolist() for n, v in arrays.items()}
        for name, table in (("labels", self.labels), ("targets", self.targets)):
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        # Numbers are written as JSON gives them back: to the last bit. Last, so that a folder with it is whole.
        tables = [n for n, t in (("labels", self.labels), ("targets", self.targets)) if t is not None]
        spark.createDataFrame([(json.dumps(state | {"tables": tables}),)], "state string").write.mode("overwrite").parquet(f"{path.rstrip('/')}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureEncoder:
        base = path.rstrip("/")
        state = json.loads(spark.read.parquet(f"{base}/state").first()["state"])
        if state["missing"] != MISSING:
            raise ValueError(f"the encoder was stored with {state['missing']!r} for missing categories, not {MISSING!r}")
        me = cls(state["cats"], state["nums"], prior=state["prior"], medians=state["medians"], scale={c: tuple(v) for c, v in state["scale"].items()})
        for name in state["tables"]:
            setattr(me, name, spark.read.parquet(f"{base}/{name}"))
        if "chained" in state:
            c = state["chained"]
            arrays = {n: np.array(c[n]) for n in ("centre", "scale", "means")}
            me.chained = ChainedImputer(c["cols"], **arrays, steps=[(r, i, np.array(w)) for r, i, w in c["steps"]], rounds=c["rounds"])
        return me
