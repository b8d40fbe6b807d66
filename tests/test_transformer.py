"""Stored encoders: the same features after reloading, also in the stream scorer."""

import math

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabcast.operators import models
from tabcast.operators.transformer import FeatureEncoder

SCHEMA = "k long, c string, e string, x double, z double, y double, other string"


def _rows(n, seed):
    return [(i, f"c{(i * seed) % 7}" if i % 5 else None, f"e{i % 3}", None if i % 6 == 0 else i * 0.37 % 11, 1e6 + i % 13 if i % 11 else None, math.sin(i * seed) + i % 7, "o") for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"target": "y", "scale": True}, {"fill": "chained", "target": "y"}, {"fill": "none"}])
def test_reloaded_encoder_makes_equal_features(spark, tmp_path, how):
    train, new = spark.createDataFrame(_rows(200, 3), SCHEMA), spark.createDataFrame([*_rows(40, 5), (99, "unseen", None, None, None, None, "o")], SCHEMA)
    fitted = FeatureEncoder.fit(train, ["c", "e"], ["x", "z"], **how)
    before = {r["k"]: r for r in fitted.transform(new).collect()}
    fitted.save(f"{tmp_path}/enc", spark)
    again = FeatureEncoder.load(spark, f"{tmp_path}/enc")
    after = {r["k"]: r for r in again.transform(new).collect()}
    assert before == after and len(after) == 41 and set(new.columns) == set(again.transform(new).columns)
    if how.get("fill") != "none":
        assert all(r["x"] is not None and r["z"] is not None for r in after.values())
    prior = train.agg(F.avg("y")).first()[0]
    assert after[99]["c"] == (-1 if "target" not in how else pytest.approx(prior))
    again.save(f"{tmp_path}/second", spark)
    assert {r["k"]: r for r in FeatureEncoder.load(spark, f"{tmp_path}/second").transform(new).collect()} == after
    with pytest.raises(ValueError):
        FeatureEncoder.fit(train, [], ["x"], fill="guess")


def test_stream_scorer_takes_the_stored_encoder(spark, tmp_path):
    from tabcast.streaming import score_stream

    train, new = spark.createDataFrame(_rows(200, 3), SCHEMA), spark.createDataFrame(_rows(60, 5), SCHEMA).drop("y")
    encoder = FeatureEncoder.fit(train, ["c", "e"], ["x", "z"], target="y", scale=True)
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    pipe = Pipeline(stages=[VectorAssembler(inputCols=["c", "e", "x", "z"], outputCol="features"), LinearRegression(labelCol="y", solver="normal")])
    model = pipe.fit(encoder.transform(train))
    models.save_model(model, f"{tmp_path}/model")
    encoder.save(f"{tmp_path}/enc", spark)
    new.write.parquet(f"{tmp_path}/in")
    q = score_stream(spark, f"{tmp_path}/in", new.schema, f"{tmp_path}/model", f"{tmp_path}/out", f"{tmp_path}/ckpt", "k", shift=0.0, clamp=None, encoder_path=f"{tmp_path}/enc")
    q.awaitTermination(120)
    got = {r["k"]: r["prediction_value"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r["k"]: math.expm1(r["prediction"]) for r in model.transform(encoder.transform(new)).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in want.items())
