"""Summary statistics: equal-width histogram and stream statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.operators.joins import one_row


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """``(bin, bin_start, bin_end, count)`` for ``bins`` equal-width bins
    between the column's min and max; the max falls in the last bin.
    Every bin is listed, empty ones with count 0.

    Two passes: a global min/max (one row, read as scalars), then a
    partial/final aggregate over at most ``bins`` groups.
    """
    spark = df.sparkSession
    vals = df.select(F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    b = one_row(vals.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    if b is None or b["lo"] is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    lo, hi = F.lit(b["lo"]).cast("double"), F.lit(b["hi"]).cast("double")
    width = hi - lo
    idx = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("_v") - lo) / width * F.lit(bins)), F.lit(bins - 1)) + 1)
    counts = vals.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    step = width / F.lit(bins)
    return (frame.join(counts, "bin", "left")
                 .select("bin",
                         (lo + (F.col("bin") - 1) * step).alias("bin_start"),
                         F.when(F.col("bin") == bins, hi)
                          .otherwise(lo + F.col("bin") * step).alias("bin_end"),
                         F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")))


def stream_stats(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Total messages, first/last message time and messages per second
    (total over the span between first and last message) per ``keys``; the
    rate is null when all messages share one timestamp."""
    span = (F.unix_micros(F.max(F.col(ts).cast("timestamp")))
            - F.unix_micros(F.min(F.col(ts).cast("timestamp"))))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.min(ts).alias("first_message"),
        F.max(ts).alias("last_message"),
        F.when(span > 0, F.count(F.lit(1)) / (span / F.lit(1e6))).alias("messages_per_sec"),
    )
