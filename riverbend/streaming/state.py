"""Streaming state in RocksDB, and reading it back.

The state of a window aggregate lives in RocksDB on the executors and is
written, as changelogs, beside the query's checkpoint in shared storage.  A
query that stops in the middle of a window therefore resumes with what the
window held, on other executors too, and the ``statestore`` source reads the
open windows from the checkpoint as a table.
"""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.session import settings
from riverbend.sources.sinks import start_stream
from riverbend.streaming.consumers import flatten_window
from riverbend.streaming.runner import await_query, read_table

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def rocksdb(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started in this block keep their state in RocksDB.  A query
    resumed later takes the store that its checkpoint names."""
    return settings(spark, ROCKSDB)


def run_windows(counts: DataFrame, root: str, timeout_s: float | None = None) -> None:
    """Run ``window_counts`` in append mode into ``root`` until its input is
    processed; run again on the same root, it goes on where it stopped."""
    root = root.rstrip("/")
    with rocksdb(counts.sparkSession):
        query = start_stream(counts, f"{root}/checkpoint", f"{root}/windows")
    await_query(query, timeout_s)


def open_windows(spark: SparkSession, root: str, alias: str = "load_dttm") -> DataFrame:
    """The windows still in the state of the query under ``root``: what they
    have counted as of its last batch."""
    rows = spark.read.format("statestore").load(f"{root.rstrip('/')}/checkpoint")
    return flatten_window(rows.select("key.*", "value.*").withColumnRenamed("window", alias), alias)


def closed_windows(spark: SparkSession, root: str, alias: str = "load_dttm") -> DataFrame:
    """The windows that the query has emitted."""
    return flatten_window(read_table(spark, f"{root.rstrip('/')}/windows"), alias)


def windows_with_state(spark: SparkSession, root: str) -> DataFrame:
    """Both: emitted windows and open ones, told apart by ``closed``."""
    return (closed_windows(spark, root).withColumn("closed", F.lit(True))
            .unionByName(open_windows(spark, root).withColumn("closed", F.lit(False))))
