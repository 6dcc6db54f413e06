"""Event-time window counts on batch DataFrames (the batch twin of the
streaming window aggregations in ``riverbend.streaming``).

``sliding_counts`` is a two-phase sliding window: rows are first counted per
``slide``-long tumbling bucket (a partial aggregate right after the scan),
and only the bucket counts fan out to the ``length / slide`` windows that
cover them.  ``F.window`` would instead expand every input row into
``length / slide`` copies (30 for 300 s / 10 s) before aggregating.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _micros(df: DataFrame, ts: str) -> F.Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _like(df: DataFrame, ts: str, micros: F.Column) -> F.Column:
    """Epoch micros back to the type of ``df[ts]`` (ntz stays ntz)."""
    out = F.timestamp_micros(micros)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        out = out.cast("timestamp_ntz")
    return out


def sliding_counts(df: DataFrame, ts: str, length_s: int, slide_s: int,
                   keys: Sequence[str] = (), count_col: str = "count") -> DataFrame:
    """Rows per ``(window_start, window_end, *keys)`` over windows of
    ``length_s`` seconds starting every ``slide_s`` seconds (epoch aligned),
    the same windows as ``F.window(ts, length, slide)``.  Rows with a null
    time are dropped, as ``window`` does."""
    keys = list(keys)
    base = df.filter(F.col(ts).isNotNull())
    if length_s % slide_s:
        w = F.window(F.col(ts).cast("timestamp"), f"{length_s} seconds", f"{slide_s} seconds")
        out = base.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(count_col))
        return out.select(_like(df, ts, F.unix_micros(F.col("w.start"))).alias("window_start"),
                          _like(df, ts, F.unix_micros(F.col("w.end"))).alias("window_end"),
                          *keys, count_col)
    step = slide_s * 1_000_000
    n = length_s // slide_s
    buckets = (base.groupBy(F.floor(_micros(df, ts) / F.lit(step)).alias("_b"), *keys)
                   .agg(F.count(F.lit(1)).alias("_n")))
    spread = buckets.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    starts = spread.groupBy((F.col("_b") - F.col("_k")).alias("_s"), *keys) \
                   .agg(F.sum("_n").alias(count_col))
    return starts.select(
        _like(df, ts, F.col("_s") * F.lit(step)).alias("window_start"),
        _like(df, ts, (F.col("_s") + F.lit(n)) * F.lit(step)).alias("window_end"),
        *keys, count_col)
