"""Streaming model scoring: a fitted pipeline applied to a stream, with the
scores banded and counted per micro-batch in ``foreachBatch``."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.functions.scores import band, positive_index, positive_probability
from riverbend.session import scratch_path
from riverbend.streaming.runner import run_batches

WINDOW = "10 seconds"


BANDS_DDL = "window_start timestamp, clean_probability string, count long, batch_id long"


def band_batch_counts(batch: DataFrame, index: int = 1, probability: Column | None = None) -> DataFrame:
    """Per batch: band of the positive-class probability (an expression, or
    element ``index`` of an ML probability vector), counted per band in
    10-second windows of processing time (the batch clock)."""
    p = positive_probability("probability", index) if probability is None else probability
    banded = batch.select(band(p).alias("clean_probability")).withColumn("time_stamp", F.current_timestamp())
    return (banded.groupBy(F.window("time_stamp", WINDOW).alias("time_stamp"), "clean_probability")
                  .count()
                  .select(F.col("time_stamp.start").alias("window_start"), "clean_probability", "count"))


def band_stream(scored: DataFrame, purpose: str = "scores", index: int = 1, probability: Column | None = None) -> str:
    """Each micro-batch's band counts of a scored stream, written to its own
    partition (``batch_id``) of a parquet table, overwritten on a retry, so a
    replayed batch is not counted twice.  Returns the table path."""
    sink = scratch_path(scored.sparkSession, f"{purpose}-out")

    def write(batch: DataFrame, batch_id: int) -> None:
        (band_batch_counts(batch, index, probability).withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(sink))

    run_batches(scored, write, purpose)
    return sink


def score_stream(model: PipelineModel, stream: DataFrame, purpose: str = "scores") -> str:
    """Run ``model`` over ``stream`` and count the bands of its micro-batches (``band_stream``)."""
    return band_stream(model.transform(stream), purpose, positive_index(model))
