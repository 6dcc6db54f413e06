"""Writers: parquet/JSON/JDBC tables, stream sinks and per-batch callbacks.

Nothing is funnelled through one task unless asked: ``single_file=True``
reproduces the reference's one-file outputs and is off by default.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverbend.session import path_exists, release


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False,
                  partition_by: list[str] | None = None) -> None:
    out = df.repartition(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              quote_all: bool = False) -> None:
    """``quote_all`` keeps a null (no quotes) apart from an empty text."""
    df.write.mode(mode).option("header", str(header).lower()).option("quoteAll", str(quote_all).lower()).option("escape", "\"").csv(path)


def write_json(df: DataFrame, path: str, mode: str = "append", single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).json(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", load_ts: bool = False) -> None:
    """Append to a database table; ``load_ts`` adds the current time as ``load_dttm``."""
    out = df.withColumn("load_dttm", F.current_timestamp()) if load_ts else df
    out.write.mode(mode).jdbc(url, table, properties=properties or {})


def write_clustered(df: DataFrame, path: str, keys: list[str], mode: str = "append",
                    partitions: int | None = None) -> None:
    """Rows hash-distributed on ``keys`` and sorted within each file (the
    warehouse's ``ORDER BY k SEGMENTED BY HASH(k)``)."""
    out = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    out.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def append_into(df: DataFrame, path: str, columns: list[str]) -> None:
    """``INSERT INTO t(cols) SELECT ..``: append a projection to a parquet table."""
    df.select(*columns).write.mode("append").parquet(path)


def create_table_if_absent(spark, path: str, ddl: str) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an empty parquet table with the schema
    (and its folder, ``CREATE SCHEMA``)."""
    if not path_exists(spark, path):
        spark.createDataFrame([], ddl).write.mode("ignore").parquet(path)


def drop_table_if_exists(spark, path: str) -> None:
    """``DROP TABLE IF EXISTS``."""
    release(spark, path)


def read_or_empty(spark, path: str, ddl: str) -> DataFrame:
    """A parquet table, empty while nothing has been written yet."""
    return spark.read.schema(ddl).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], ddl)


def start_stream(df: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet",
                 output_mode: str = "append", trigger: dict | None = None,
                 query_name: str | None = None) -> StreamingQuery:
    """Start a checkpointed streaming write.  ``trigger`` defaults to
    ``availableNow`` (process what is there, then stop)."""
    w = df.writeStream.outputMode(output_mode).format(fmt).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path) if path else w.start()


def start_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """``foreachBatch`` with a checkpoint: ``fn(batch_df, batch_id)`` per micro-batch."""
    return (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())


def start_foreach(df: DataFrame, writer, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``foreach`` with a checkpoint: ``writer`` (``open``, ``process``, ``close``) sees every record in the executors."""
    return df.writeStream.foreach(writer).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def index_documents(df: DataFrame, mapping: dict[str, str], time_fields=("CREATEDAT",)) -> DataFrame:
    """Project a stream onto a search-index mapping: epoch-millis date fields
    become timestamps, keyword/text fields strings; the message key is not used."""
    cols = []
    for name, kind in mapping.items():
        if kind == "date" or name in time_fields:
            cols.append(F.timestamp_millis(F.col(name).cast("long")).alias(name))
        else:
            cols.append(F.col(name).cast("string").alias(name))
    return df.select(*cols)
