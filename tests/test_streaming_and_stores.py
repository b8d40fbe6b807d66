"""Stream scoring with a saved pipeline equals batch scoring; stores round-trip."""

import tempfile

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    from tabcast.operators import models, split
    from tabcast.plans.catalogue import KEY, LOG, engineered
    from tabcast.schema import columns_by_type
    from tabcast.streaming import score_stream

    df = engineered(spark, SF_SMALL).withColumn("is_valid", split.holdout_flag(KEY, 0.2, 42))
    cats, nums = columns_by_type(df, exclude=(KEY, "Transport_Cost", LOG, "Target_Shift_Value",
                                              "Hospital_Location", "Supplier_Name"))
    pipe = models.dtype_dispatch(nums, cats, LinearRegression(labelCol=LOG, solver="l-bfgs"))
    m = pipe.fit(df.filter(~F.col("is_valid")))
    base = tempfile.mkdtemp(prefix="tabcast-stream-", dir="/tmp")
    models.save_model(m, f"{base}/model")
    valid = df.filter(F.col("is_valid")).drop(LOG, "Transport_Cost")
    valid.write.parquet(f"{base}/in")
    q = score_stream(spark, f"{base}/in", valid.schema, f"{base}/model", f"{base}/out", f"{base}/ckpt", KEY,
                     shift=0.0, clamp=None)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{base}/out").select(KEY, "prediction_value")
    exp = m.transform(valid).select(KEY, (F.expm1("prediction")).alias("exp"))
    j = got.join(exp, KEY).withColumn("d", F.abs(F.col("prediction_value") - F.col("exp")))
    assert j.count() == valid.count()
    assert j.agg(F.max("d")).first()[0] < 1e-6


def test_model_store_roundtrip(spark):
    from tabcast.plans.modelling import q_model_store

    r = q_model_store(spark, SF_SMALL).withColumn("d", F.abs(F.col("pred_before") - F.col("pred_after")))
    assert r.count() > 0 and r.agg(F.max("d")).first()[0] == 0.0


def test_prediction_store_needs_weighted_models(spark, tmp_path):
    import pytest

    from tabcast.sources import sinks

    path = f"{tmp_path}/preds"
    rows = [(1, "a", 2.0), (2, "a", 4.0), (1, "b", 1.0), (2, "b", 3.0)]
    sinks.save_predictions(spark.createDataFrame(rows, "k long, model string, pred double"), path)
    with pytest.raises(ValueError):
        sinks.load_predictions(spark, path, "c")
    with pytest.raises(ValueError):
        sinks.weighted_predictions(spark, path, {"a": 0.5, "c": 0.5}, "k")
    got = sinks.weighted_predictions(spark, path, {"a": 0.5, "b": 0.5, "c": 0.0}, "k")
    assert {r["k"]: r["pred"] for r in got.collect()} == {1: 1.5, 2: 3.5}
    assert {r["pred"] for r in sinks.weighted_predictions(spark, path, {"a": 0.0}, "k").collect()} == {0.0}
