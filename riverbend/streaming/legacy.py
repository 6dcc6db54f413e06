"""The micro-batch consumer of the older stream job, on Structured Streaming.

Per batch: infer the schema of the batch's JSON texts, log it, and if the
required columns are there count non-bot events per type and 5-second
interval of arrival (else nothing).  The counts are summed per type over
sliding windows of arrival time (5 minutes every 10 seconds), either in
batch over the stored counts or while the stream runs, in a state store.

Every text is parsed once, to a variant: one pass over the batch counts the
events and, as an observed aggregate of the same pass, merges the schemas of
all messages.  No text is written.  A message that is no JSON object (or has
a key twice) adds no column and is not counted; it is reported in the log.
The time of arrival is a column of the feed (a topic's message timestamp),
so a replay gives the same counts.
"""

from __future__ import annotations

import logging
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from riverbend.operators.joins import latest_per_key
from riverbend.session import path_exists, release, save, scratch_path, settings
from riverbend.sources.readers import file_stream
from riverbend.sources.sinks import read_or_empty, start_batches
from riverbend.streaming.consumers import EXCLUDED_TYPE, arrival_window_sums
from riverbend.streaming.runner import await_query, run_batches

log = logging.getLogger(__name__)

BATCH_SECONDS = 5
REQUIRED = ("bot", "type")
COUNTS_DDL = "type string, count long, load_dttm timestamp, batch_id long"
SUMS_DDL = "window_start timestamp, window_end timestamp, type string, count long, batch_id long"


# a plan whose shuffle turns out empty would be replaced, and what it observed lost
KEEP_EMPTY = {"spark.sql.adaptive.optimizer.excludedRules": "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}


class Inferred(NamedTuple):
    """What a batch's messages look like: their merged columns, and how many are no JSON object."""
    columns: dict[str, DataType]
    malformed: int


def _is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT<")


def observed(batch: DataFrame, value: str = "value", parsed: str = "v") -> tuple[DataFrame, Observation]:
    """``batch`` with its texts parsed to the variant column ``parsed`` (null
    where a text is no JSON), and an observation of the merged schema, to be
    read with ``inferred`` after the batch has been computed."""
    seen = Observation()
    v = F.col(parsed)
    rows = batch.select("*", F.try_parse_json(value).alias(parsed))
    return rows.observe(seen, F.schema_of_variant_agg(F.when(_is_object(v), v)).alias("schema"),
                        F.count_if(F.col(value).isNotNull() & ~F.coalesce(_is_object(v), F.lit(False))).alias("malformed")), seen


def inferred(seen: Observation) -> Inferred:
    """The observed columns with their types; no columns for an empty batch."""
    found = seen.get
    text = re.fullmatch(r"OBJECT<(.*)>", found.get("schema") or "", re.S)
    # field names that need it are quoted, so only types are rewritten
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", text[1]) if text else ""
    fields = StructType.fromDDL(ddl) if ddl else StructType([])
    return Inferred({f.name: f.dataType for f in fields.fields}, found.get("malformed") or 0)


def type_counts(rows: DataFrame, arrived: str = "arrived", parsed: str = "v", excluded_type: str = EXCLUDED_TYPE) -> DataFrame:
    """Non-bot events of parsed messages per type and arrival interval of ``BATCH_SECONDS``:
    ``type, count, load_dttm``.  A null, or other than true or false, ``bot`` is left out, as are a null and the excluded type."""
    v = F.col(parsed)
    kind = F.try_variant_get(v, "$.type", "string")
    events = rows.select(kind.alias("type"), F.try_variant_get(v, "$.bot", "boolean").alias("bot"),
                         F.window(F.col(arrived), f"{BATCH_SECONDS} seconds")["start"].alias("load_dttm"))
    events = events.where((F.col("bot") == F.lit(False)) & (F.col("type") != excluded_type))
    return events.groupBy("type", "load_dttm").agg(F.count(F.lit(1)).alias("count")).select("type", "count", "load_dttm")


def _counted(batch: DataFrame, arrived: str) -> tuple[DataFrame, str, Inferred]:
    """The counts of a batch, saved (a few rows for each five seconds) under a path, and what its messages look like."""
    rows, seen = observed(batch)
    with settings(batch.sparkSession, KEEP_EMPTY):
        counts, path = save(type_counts(rows, arrived), "batch-counts")
    return counts, path, inferred(seen)


def batch_type_counts(batch: DataFrame, arrived: str = "arrived") -> DataFrame:
    """``type, count, load_dttm`` of a batch; empty unless all ``REQUIRED``
    columns are among those inferred from the whole batch."""
    counts, _, found = _counted(batch, arrived)
    return counts if found.columns.keys() >= set(REQUIRED) else counts.limit(0)


def write_batch_counts(batch: DataFrame, batch_id: int, sink: str, arrived: str = "arrived") -> Inferred:
    """Count a batch into its own partition of ``sink``, if it has the
    ``REQUIRED`` columns.  A batch run again replaces what it wrote."""
    counts, path, found = _counted(batch, arrived)
    for name, kind in found.columns.items():
        log.info("inferred column %s: %s", name, kind.simpleString())
    if found.malformed:
        log.warning("batch %d: %d messages are no JSON objects", batch_id, found.malformed)
    if found.columns.keys() >= set(REQUIRED):
        (counts.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(sink))
    else:
        log.warning("batch %d has not the columns %s", batch_id, ", ".join(REQUIRED))
    release(batch.sparkSession, path)
    return found


def _counter(sink: str, arrived: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_counts(batch, batch_id, sink, arrived)
    return write


def run_legacy_counts(stream: DataFrame, purpose: str = "legacy", arrived: str = "arrived") -> DataFrame:
    """Run the per-batch counts over ``stream`` (columns ``value`` and
    ``arrived``); returns the table ``type, count, load_dttm, batch_id``.
    The clock is the messages' own, so how the input falls into micro-batches
    does not change the sums."""
    sink = scratch_path(stream.sparkSession, f"{purpose}-counts")
    run_batches(stream, _counter(sink, arrived), purpose)
    return read_or_empty(stream.sparkSession, sink, COUNTS_DDL)


def windowed_type_counts(counts: DataFrame) -> DataFrame:
    """5-minute sums every 10 seconds of arrival time: ``window_start,
    window_end, type, count``."""
    w = arrival_window_sums(counts, "load_dttm", "300 seconds", "10 seconds", ("type",), "count")
    return w.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"), "type", "count")


class LiveSums:
    """Sliding sums that are kept in a state store and emitted while the stream runs.

    Two checkpointed queries under ``root``: the first counts every batch of
    messages (``write_batch_counts``), the second reads those counts as they
    appear, adds them to the sums of the windows they fall in and writes each
    changed sum.  The state holds one number for each type and window that
    is not yet older than ``delay`` behind the latest arrival; older windows
    leave the state, and counts that come later still are dropped.  Both go
    on from their checkpoints when run again.
    """

    def __init__(self, spark, root: str, delay: str = "20 seconds", length: str = "300 seconds", slide: str = "10 seconds"):
        self.spark, self.root, self.delay, self.length, self.slide = spark, root.rstrip("/"), delay, length, slide
        self.counts, self.sums = f"{self.root}/counts", f"{self.root}/sums"

    def _write_sums(self, changed: DataFrame, batch_id: int) -> None:
        (changed.select("window.start", "window.end", "type", "count").toDF("window_start", "window_end", "type", "count")
                .withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.sums))

    def start_counts(self, stream: DataFrame, arrived: str = "arrived", trigger: dict | None = None):
        return start_batches(stream, _counter(self.counts, arrived), f"{self.root}/counts-checkpoint", trigger)

    def start_sums(self, trigger: dict | None = None):
        """The second query; the folder of counts must be there."""
        counts = file_stream(self.spark, self.counts, COUNTS_DDL, fmt="parquet", max_files_per_trigger=None)
        live = arrival_window_sums(counts.withWatermark("load_dttm", self.delay), "load_dttm", self.length, self.slide, ("type",), "count")
        writer = live.writeStream.outputMode("update").foreachBatch(self._write_sums)
        return writer.option("checkpointLocation", f"{self.root}/sums-checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def advance(self, stream: DataFrame, arrived: str = "arrived") -> None:
        """Process what ``stream`` has now through both queries."""
        await_query(self.start_counts(stream, arrived))
        if path_exists(self.spark, self.counts):
            await_query(self.start_sums())

    def table(self) -> DataFrame:
        """The sums as of now: of each window and type, the one written last."""
        rows = latest_per_key(read_or_empty(self.spark, self.sums, SUMS_DDL), ["window_start", "window_end", "type"], ["batch_id"])
        return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                           F.col("window_end").cast("timestamp_ntz").alias("window_end"), "type", "count")
