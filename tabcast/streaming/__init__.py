"""Incremental scoring with Structured Streaming.

The reference is batch only (no watermarks, windows or state). The one step that makes
sense on arriving data is its final one — predict unlabelled rows with a fitted model,
invert the log target, clamp, write id,value — so that step is offered on a file stream:
``score_stream`` applies a saved ``PipelineModel`` to each micro-batch and appends the
predictions. Exactly-once comes from the streaming checkpoint plus an idempotent batch write.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabcast.functions.mathx import clamp_min, inverse_target
from tabcast.operators.transformer import FeatureEncoder


def score_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    model_path: str,
    sink_dir: str,
    checkpoint_dir: str,
    key: str,
    shift: float,
    out_col: str = "prediction_value",
    clamp: float | None = 0.0,
    available_now: bool = True,
    encoder_path: str | None = None,
):
    """Score parquet files arriving in ``source_dir`` and append (key, value) to ``sink_dir``.

    ``encoder_path``: a stored ``FeatureEncoder`` that makes the model's features from the arriving rows.
    """
    model = PipelineModel.load(model_path)
    encoder = FeatureEncoder.load(spark, encoder_path) if encoder_path else None
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        value = inverse_target("prediction", shift)
        if clamp is not None:
            value = clamp_min(value, clamp)
        rows = batch if encoder is None else encoder.transform(batch)
        scored = model.transform(rows).select(key, value.alias(out_col), F.lit(batch_id).alias("batch_id"))
        # overwrite only this batch's partition: a replayed batch replaces its own output
        (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
