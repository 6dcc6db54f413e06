"""Running streaming queries to completion and reading their output back.

Every run takes fresh checkpoint and output folders under the shared
scratch root (``spark.checkpoint.dir``): a checkpoint records what was
read, so reusing one would read nothing.  The ``availableNow`` trigger
processes everything present, runs a closing batch so the final watermark
emits the windows it closed, and stops; the checkpoint makes a restart
after an executor or driver loss resume where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from riverbend.session import scratch_path
from riverbend.sources.sinks import start_batches, start_stream


def run_to_table(stream: DataFrame, purpose: str, fmt: str = "parquet",
                 output_mode: str = "append", timeout_s: float | None = None) -> str:
    """Run ``stream`` into a fresh sink folder until all input is processed;
    returns the folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{purpose}-out")
    chk = scratch_path(spark, f"{purpose}-chk")
    q = start_stream(stream, chk, out, fmt=fmt, output_mode=output_mode)
    await_query(q, timeout_s)
    return out


def run_batches(stream: DataFrame, fn: Callable[[DataFrame, int], None], purpose: str,
                timeout_s: float | None = None) -> str:
    """Run ``foreachBatch(fn)`` to completion; returns the checkpoint folder."""
    chk = scratch_path(stream.sparkSession, f"{purpose}-chk")
    q = start_batches(stream, fn, chk)
    await_query(q, timeout_s)
    return chk


def await_query(q, timeout_s: float | None = None) -> None:
    """Wait until the query ends: without a limit, or ``timeout_s`` seconds,
    after which it is stopped and a TimeoutError raised."""
    finished = q.awaitTermination() is None if timeout_s is None else q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Wait until any query of the session has ended; a TimeoutError if none
    has after ``timeout_s`` seconds (no limit by default)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
    elif not spark.streams.awaitAnyTermination(timeout_s):
        raise TimeoutError(f"no streaming query ended in {timeout_s}s")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


class ProgressTotals(StreamingQueryListener):
    """Exact totals of every query started while the listener is registered
    (``spark.streams.addListener``).  A query itself keeps its last 100
    reports only, so totals are added up as the reports arrive."""

    def __init__(self) -> None:
        self._of: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self._of[str(event.id)] = {"total_messages": 0, "input_rows_per_sec": 0.0,
                                   "processed_rows_per_sec": 0.0, "last_batch": None, "batches": 0}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        st = self._of[str(p.id)]
        st["batches"] += 1
        st["total_messages"] += int(p.numInputRows)
        if p.numInputRows or st["last_batch"] is None:
            st.update(input_rows_per_sec=float(p.inputRowsPerSecond or 0.0),
                      processed_rows_per_sec=float(p.processedRowsPerSecond or 0.0), last_batch=p.timestamp)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, q) -> dict:
        """Total input rows, the latest input and processing rates, time of
        the last batch with rows, and number of reports of one query."""
        return dict(self._of[str(q.id)])


def progress_totals(spark: SparkSession) -> ProgressTotals:
    """Register and return a ``ProgressTotals``."""
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    return totals
