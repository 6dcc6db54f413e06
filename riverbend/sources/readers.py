"""Readers for every source kind the reference uses.

Batch: CSV with/without header and a fixed schema, typed JSON lines
(FAILFAST), parquet, JDBC (partitioned reads), number ranges.
Streaming: message-bus topics (format as a parameter; the Kafka connector
must be on the classpath), JSON/parquet file streams with a files-per-
trigger limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.session import is_file, scratch_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             sep: str = ",", encoding: str = "utf-8", mode: str = "PERMISSIVE",
             multi_line: bool = False) -> DataFrame:
    """CSV with a fixed schema.  With ``header=True`` the first line is skipped
    and columns bind by position (the header text is not used); a cell that
    does not parse becomes null in PERMISSIVE mode.  ``multi_line`` allows
    quoted fields holding line breaks (such files are not split)."""
    return (spark.read.option("header", str(header).lower()).option("sep", sep)
                 .option("encoding", encoding).option("mode", mode)
                 .option("escape", "\"").option("enforceSchema", "true").option("multiLine", str(multi_line).lower())
                 .schema(schema).csv(path))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      fail_fast: bool = True) -> DataFrame:
    """JSON lines to typed records; a malformed line fails the job (FAILFAST)
    unless ``fail_fast=False``."""
    return (spark.read.schema(schema)
                 .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
                 .json(path))


def read_json_inferred(spark: SparkSession, path_or_df) -> DataFrame:
    """JSON with the schema inferred from all the data (a path, or a DataFrame
    holding one JSON text per row in column ``value``).  A DataFrame is
    written as text to the shared scratch folder and read back, so the
    inference runs in the JVM over every row (no Python row loop).  Line
    breaks are white space in JSON and become blanks, as a text is one line."""
    if isinstance(path_or_df, DataFrame):
        path = scratch_path(spark, "json-texts")
        path_or_df.select(F.translate("value", "\r\n", "  ").alias("value")).write.text(path)
        return spark.read.json(path)
    return spark.read.json(path_or_df)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table.  With a numeric ``partition_column`` and bounds the
    read is split into ``num_partitions`` range queries run in parallel;
    filters and column pruning are pushed into the database query."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower)).option("upperBound", str(upper))
                        .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def number_range(spark: SparkSession, n: int) -> DataFrame:
    """``spark.range(n)`` (column ``id``)."""
    return spark.range(n)


def topic_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 fmt: str = "kafka", options: dict | None = None) -> DataFrame:
    """A message-bus topic as a stream of ``key, value, topic, partition,
    offset, timestamp``.  ``starting_offsets`` is ``earliest`` or ``latest``;
    offsets are tracked in the query checkpoint (no auto-commit)."""
    reader = (spark.readStream.format(fmt).option("kafka.bootstrap.servers", servers)
                   .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                max_files_per_trigger: int | None = 1, glob: str | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream, in batches of ``max_files_per_trigger``
    files or about ``max_bytes_per_trigger`` bytes."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The table ``{sf_dir}/{name}.parquet`` replayed as a stream.

    A table stored as one file is streamed from its folder with a file-name
    filter (a file stream needs a folder); a table stored as a folder of
    part files is streamed from that folder.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    batch = spark.read.parquet(path)
    if is_file(spark, path):
        return file_stream(spark, sf_dir, batch.schema, fmt="parquet",
                           max_files_per_trigger=max_files_per_trigger, glob=f"{name}.parquet")
    return file_stream(spark, path, batch.schema, fmt="parquet",
                       max_files_per_trigger=max_files_per_trigger)
