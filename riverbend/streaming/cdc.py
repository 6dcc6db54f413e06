"""Applying a CDC stream to a current table with ``foreachBatch``
(merge on read).

Each micro-batch parses its envelopes, keeps the last change per key within
the batch, and writes those rows to its own partition of a change-log table,
named by the query and the batch (dynamic partition overwrite: a retried
batch replaces exactly what it wrote before, and nothing else does).  The
checkpoint lies beside the log, so a later run on the same root continues
where the last one stopped.

The current table is read as one aggregate over the log: per key the change
that is last by ``ORDER``, without the keys whose last change is a delete.
The order starts with the log position (``lsn``), which tells apart the
changes of one transaction; sources without one are ordered by their time,
transaction and message offset, and a delete is last among equals.  The
aggregate has a map-side partial step, so a key changed in every batch is
combined inside each scan task.  Because the last change wins wherever it
is stored, batches may arrive in any order and an older insert never
resurrects a deleted key.  When the log has many partitions it is rewritten
as one (tombstones kept); the old ones are deleted only after the new one is
complete, and reading both gives the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.operators.joins import latest_per_key
from riverbend.operators.keyed import OP_DELETE
from riverbend.operators.records import parse_cdc
from riverbend.session import list_folders, path_exists, release
from riverbend.sources.sinks import start_batches
from riverbend.streaming.runner import await_query

ORDER = ["lsn", "ts_ms", "txid", "offset", "deleted"]
CHANGE_DDL = ("id int, lsn long, ts_ms long, txid long, offset long, deleted boolean, op string, "
              "first_name string, last_name string, email string")
STATE_COLUMNS = [c.split()[0] for c in CHANGE_DDL.split(", ")]
LOG_DDL = CHANGE_DDL + ", n_messages long, query_id string, batch_id long"

# partitions of the log after which it is rewritten as one
COMPACT_PARTITIONS = 64


def change_rows(messages: DataFrame, offset: str = "offset") -> DataFrame:
    """CDC envelopes -> one change row per message, keyed by the row id.
    ``offset`` is the message's place in its feed, if the feed has that column."""
    has_offset = offset in messages.columns
    p = parse_cdc(messages, keep=(offset,) if has_offset else ())
    return p.select(
        F.coalesce(F.col("after_id"), F.col("before_id")).alias("id"),
        F.col("source_lsn").alias("lsn"), "ts_ms", F.col("source_txid").alias("txid"),
        (F.col(offset).cast("long") if has_offset else F.lit(None).cast("long")).alias("offset"),
        (F.col("op") == OP_DELETE).alias("deleted"), "op",
        F.col("after_first_name").alias("first_name"),
        F.col("after_last_name").alias("last_name"),
        F.col("after_email").alias("email"),
    )


def last_changes(changes: DataFrame) -> DataFrame:
    """The last change per key by ``ORDER`` (deletes kept)."""
    return latest_per_key(changes.select(*STATE_COLUMNS), ["id"], ORDER)


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/changes"


def _read_log(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, _log_path(root)):
        return spark.createDataFrame([], LOG_DDL)
    return spark.read.schema(LOG_DDL).parquet(_log_path(root))


def _with_counts(changes: DataFrame) -> DataFrame:
    """The last change per key and ``n_messages``, how many there were of the key."""
    n = F.sum(F.coalesce("n_messages", F.lit(1)) if "n_messages" in changes.columns else F.lit(1)).cast("long")
    row = F.max(F.struct(*ORDER, *[c for c in STATE_COLUMNS if c not in ("id", *ORDER)]))
    return changes.groupBy("id").agg(row.alias("_row"), n.alias("n_messages")).select("id", "_row.*", "n_messages").select(*STATE_COLUMNS, "n_messages")


def _write_partition(changes: DataFrame, root: str, query_id: str, batch_id: int) -> None:
    (_with_counts(changes).withColumn("query_id", F.lit(query_id)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("query_id", "batch_id").parquet(_log_path(root)))


# what names a message of the feed: its key, and its place in the database's log
_POSITION = "payload struct<source: struct<lsn: string>>"


def once(stream: DataFrame, delay: str = "1 day", key: str = "key", value: str = "value") -> DataFrame:
    """``stream`` without messages delivered again within ``delay`` of the first
    delivery: those of equal key and log position (of equal text, where a message has none).

    The clock of the watermark is the time of the batch that reads a message,
    not the message's own, so that no message is ever too late to be applied;
    the state holds the key and position of each message for ``delay``."""
    lsn = F.from_json(value, _POSITION)["payload"]["source"]["lsn"]
    marked = stream.withColumns({"_seen": F.current_timestamp(), "_place": F.coalesce(lsn, F.sha2(value, 256), F.lit(""))})
    return marked.withWatermark("_seen", delay).dropDuplicatesWithinWatermark([key, "_place"]).drop("_seen", "_place")


def make_batch_writer(root: str, compact_partitions: int = COMPACT_PARTITIONS):
    """``foreachBatch`` function appending each batch's last changes per key."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        _write_partition(change_rows(batch), root, query_id, batch_id)
        if len(_partitions(spark, root)) > compact_partitions:
            compact(spark, root)
    return apply


def apply_stream(stream: DataFrame, root: str, timeout_s: float | None = None) -> None:
    """Apply what ``stream`` has to the log under ``root``; run again, it goes
    on from the checkpoint kept there."""
    q = start_batches(stream, make_batch_writer(root), f"{root.rstrip('/')}/checkpoint")
    await_query(q, timeout_s)


def current_table(spark: SparkSession, root: str) -> DataFrame:
    """The current rows: ``id, first_name, last_name, email``."""
    return (last_changes(_read_log(spark, root)).filter(F.col("op") != OP_DELETE)
            .select("id", "first_name", "last_name", "email"))


def applied(spark: SparkSession, root: str) -> DataFrame:
    """``id, n_messages``: how many messages of each row have been applied."""
    return _read_log(spark, root).groupBy("id").agg(F.sum(F.coalesce("n_messages", F.lit(1))).cast("long").alias("n_messages"))


def _partitions(spark: SparkSession, root: str) -> list[str]:
    return [batch for query in list_folders(spark, _log_path(root)) for batch in list_folders(spark, query) if "batch_id=" in batch]


def compact(spark: SparkSession, root: str) -> None:
    """Rewrite the log's partitions as one (tombstones kept), then delete them."""
    old = _partitions(spark, root)
    if len(old) < 2:
        return
    log = spark.read.schema(LOG_DDL).option("basePath", _log_path(root)).parquet(*old)
    _write_partition(log, root, f"compacted-{uuid.uuid4().hex}", 0)
    release(spark, *old)
