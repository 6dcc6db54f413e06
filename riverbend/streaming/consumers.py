"""Stream consumers as DataFrame functions (work on batch and streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value of the reference consumer: the event type that is not counted.
EXCLUDED_TYPE = "142"


def guarded_type_counts(df: DataFrame, required: str = "bot",
                        excluded_type: str = EXCLUDED_TYPE, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per-batch guard + count: when the batch has the ``required`` column,
    count non-bot events per type (and ``keys``) (type ``excluded_type`` left out; a null
    ``bot`` or ``type`` is left out too); otherwise an empty result."""
    if required not in df.columns:
        spark = df.sparkSession
        return spark.createDataFrame([], T.StructType([T.StructField("type", T.StringType()),
                                                       T.StructField("count", T.LongType())]))
    kept = df.filter((F.col("bot") == F.lit(False)) & (F.col("type") != F.lit(excluded_type)))
    return kept.groupBy("type", *keys).agg(F.count(F.lit(1)).alias("count"))


def window_counts(df: DataFrame, ts: str = "timestamp", length: str = "20 seconds",
                  slide: str | None = "10 seconds", watermark: str | None = "20 seconds",
                  keys=("type",), alias: str = "load_dttm") -> DataFrame:
    """Event-time window counts per key with a watermark.

    In append mode each window is emitted once, after the watermark (max
    event time seen minus the delay, as of the previous batch) passes its
    end; rows later than that are dropped.  ``ts`` must be a ``timestamp``
    (instant) column.
    """
    src = df.withWatermark(ts, watermark) if watermark else df
    w = F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)
    return src.groupBy(w.alias(alias), *keys).count()


def non_bot_changes(changes: DataFrame) -> DataFrame:
    """Typed change events -> ``type, bot, timestamp`` of non-bot events
    (a null ``bot`` is dropped, as ``bot = false`` does)."""
    return (changes.select("type", "bot", F.col("timestamp").cast("timestamp").alias("timestamp"))
                   .filter(F.col("bot") == F.lit(False)))


def flatten_window(df: DataFrame, alias: str = "load_dttm", ntz: bool = True) -> DataFrame:
    """``struct<start,end>`` window column -> ``window_start, window_end``."""
    start, end = F.col(f"{alias}.start"), F.col(f"{alias}.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != alias]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


# Fixed values of the language stream: the five projected fields.
LANG_FIELDS = ("CREATEDAT", "CHANNEL", "USERNAME", "WIKIPAGE", "DIFFURL")


def filtered_projection(df: DataFrame, excluded_channel: str) -> DataFrame:
    """Continuous filtered projection: drop the excluded channel and bots,
    keep the five language-stream fields (null channel or flag dropped)."""
    return (df.filter((F.col("CHANNEL") != F.lit(excluded_channel)) & (F.col("ISBOT") == F.lit(False)))
              .select(*LANG_FIELDS))


def arrival_window_sums(counts: DataFrame, clock: str = "load_dttm", length: str = "300 seconds",
                        slide: str = "10 seconds", keys=("type",), value: str = "count") -> DataFrame:
    """Sum per key over a sliding window of *arrival* time.

    The legacy consumer reduced per-batch counts over the last 5 minutes every
    10 seconds of processing time.  Here each batch's counts carry the
    batch clock (``clock``), and the windows are aligned to the epoch rather
    than to the stream start.
    """
    # a cast would hide the clock's watermark
    at = F.col(clock) if isinstance(counts.schema[clock].dataType, T.TimestampType) else F.col(clock).cast("timestamp")
    w = F.window(at, length, slide)
    return counts.groupBy(w.alias("window"), *keys).agg(F.sum(value).alias(value))
