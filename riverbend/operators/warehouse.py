"""The warehouse as catalog tables: schema, segmented tables, the load chain.

``SEGMENTED BY HASH(k) ALL NODES`` with ``ORDER BY k`` becomes a table
bucketed and sorted by k in the session catalog.  Readers know the layout, so
the load's anti joins and the current view join the stored side where it
lies: only the stage's side is shuffled, to the buckets.  A key of several
columns needs only the segmentation column to be co-located.  An unsegmented
table (the file log, a few rows a load) is a plain one.

The catalog is the session's; with a metastore the tables outlive it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from riverbend.operators import vault
from riverbend.session import release, save, settings

# a join on (a, b) may use tables that are laid out by a alone
COLOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
BUCKETS = 8

STAGE_DDL = ("District string, Crimes_total long, Crimes_monthly long, Frequent_crime_types string, "
             "Lat decimal(37,15), Lng decimal(37,15)")
# Fixed values of the stage table: its key and NOT NULL columns.
STAGE_KEY, STAGE_NOT_NULL = ["District"], ["District", "Crimes_total", "Crimes_monthly"]


def _name(name: str) -> str:
    """A quoted identifier of one or more parts."""
    parts = name.split(".")
    if not all(re.fullmatch(r"\w+", part) for part in parts):
        raise ValueError(f"not a table or schema name: {name!r}")
    return ".".join(f"`{part}`" for part in parts)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``, in the warehouse folder or at ``location``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(name)}" + (" LOCATION {at}" if location else ""), **({"at": location} if location else {}))


def drop_schema(spark: SparkSession, name: str) -> None:
    """``DROP SCHEMA IF EXISTS .. CASCADE``: its tables go as well."""
    spark.sql(f"DROP SCHEMA IF EXISTS {_name(name)} CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")


def create_external_table(spark: SparkSession, name: str, ddl: str, path: str) -> None:
    """A table over parquet files that stay where they are when it is dropped."""
    spark.sql(f"CREATE TABLE {_name(name)} ({ddl}) USING parquet LOCATION {{at}}", at=path)


def create_segmented_table(spark: SparkSession, name: str, ddl: str, segmented_by: list[str], order_by: list[str] = (),
                           buckets: int = BUCKETS) -> None:
    """``CREATE TABLE IF NOT EXISTS`` of a table hash-distributed on
    ``segmented_by`` into ``buckets`` and sorted on ``order_by`` (default: the
    same columns) within each; without ``segmented_by``, of a plain one.

    A bucket is read, and a load of it written, by one task.  So ``buckets``
    grows with the table (its size / 1 GB, say), and ``segmented_by`` are
    columns of many values: the load's tables have unique keys."""
    layout = ""
    if segmented_by:
        order = ", ".join(map(_name, order_by or segmented_by))
        layout = f"CLUSTERED BY ({', '.join(map(_name, segmented_by))}) SORTED BY ({order}) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({ddl}) USING parquet {layout}")


def layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """The columns a table is bucketed by, and its buckets (none, 0 for a plain table)."""
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_name(name)}").collect()}
    n = int(found.get("Num Buckets", 0))
    return (re.findall(r"`([^`]+)`", found["Bucket Columns"]), n) if n else ([], 0)


def insert_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """``INSERT INTO t(cols) SELECT ..``, by column names.  For a segmented
    table the rows are first shuffled to their buckets, so that a load writes
    one file a bucket, not one for each task and bucket."""
    spark = df.sparkSession
    keys, buckets = layout(spark, name)
    rows = df.select(*spark.table(name).columns)
    rows = rows.repartition(buckets, *keys) if keys else rows
    rows.write.insertInto(name, overwrite=overwrite)


class Warehouse:
    """The load's tables in one schema: ``crimes`` stage, file log, ODS, hub and satellite."""

    def __init__(self, spark: SparkSession, schema: str, buckets: int = BUCKETS, location: str | None = None):
        self.spark, self.schema, self.buckets, self.location = spark, schema, buckets, location

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def create(self) -> None:
        """The schema and its tables, where they are absent."""
        create_schema(self.spark, self.schema, self.location)
        create_segmented_table(self.spark, self.name("stage"), STAGE_DDL, STAGE_KEY, buckets=self.buckets)
        for table, (ddl, key, segment, _) in vault.TABLES.items():
            segmented = [] if table == "file_log" else segment
            create_segmented_table(self.spark, self.name(table), ddl, segmented, [*segment, *(k for k in key if k not in segment)] if segmented else [],
                                   self.buckets)

    def drop(self) -> None:
        drop_schema(self.spark, self.schema)

    def _append(self, table: str, delta: DataFrame, check: bool) -> int:
        delta, path = save(delta, f"delta-{table}")  # it reads the table it extends
        n = vault.checked_rows(table, delta, check)
        if n:
            insert_into(delta, self.name(table))
        release(self.spark, path)
        return n

    def fill_stage(self, rows: DataFrame, check: bool = True) -> None:
        """Replace the stage by ``rows``, whose key and NOT NULL columns are checked."""
        if check:
            vault.enforce(rows, STAGE_KEY, STAGE_NOT_NULL)
        insert_into(rows, self.name("stage"), overwrite=True)

    def load(self, source: str = vault.SOURCE, file_name: str = vault.FILE_NAME, load_ts=None, check_keys: bool = True) -> dict[str, int]:
        """One run of the load from the stage table; the rows added per table.
        A rerun with the same stage adds nothing."""
        added = {}
        with settings(self.spark, COLOCATED):
            stage = self.table("stage")
            added["file_log"] = self._append("file_log", vault.new_file_rows(stage, self.table("file_log"), source, file_name, load_ts), check_keys)
            log = self.table("file_log")
            row = vault.current_file_row(log, source, file_name)
            added["ods"] = self._append("ods", vault.ods_delta(stage, log, self.table("ods"), source, file_name, row), check_keys)
            added["hub"] = self._append("hub", vault.hub_delta(stage, log, self.table("hub"), source, file_name, row), check_keys)
            added["satellite"] = self._append("satellite", vault.sat_delta(stage, log, self.table("satellite"), source, file_name, row, load_ts), check_keys)
        return added

    def current(self) -> DataFrame:
        return vault.current_view(self.table("hub"), self.table("satellite"))
