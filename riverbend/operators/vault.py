"""Incremental warehouse load (domain C): file log, operational store (ODS),
hub and satellite tables, and the current view.

Every step is a DataFrame function; the table-writing driver
``run_load_chain`` appends each delta to parquet tables.  Deltas are anti
joins against the target, so a rerun with the same stage adds nothing, and
a changed metric adds exactly one satellite row.

Scale notes: the stage is one row per business key; the file log is a tiny
metadata table.  The reference joins on constants with the latest log row;
here that one row is read as scalars and attached as literals (no cross
join).  Hub and satellite anti joins
shuffle on the hash key (AQE splits a skewed key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.functions.hashing import hash_key, hashdiff
from riverbend.operators.joins import anti_join, latest_per_key, one_row
from riverbend.session import release, save

# Fixed values of the reference load: the source system and the file name
# of the operational stage.
SOURCE = "ERP"
FILE_NAME = "STG_OPER"

LOG_SCHEMA = T.StructType([
    T.StructField("FILE_ID", T.LongType(), False),
    T.StructField("SOURCE", T.StringType(), False),
    T.StructField("FILE_NAME", T.StringType(), False),
    T.StructField("LOAD_TS", T.TimestampNTZType(), False),
])

STAGE_COLUMNS = ["District", "Crimes_total", "Crimes_monthly", "Frequent_crime_types", "Lat", "Lng"]

# The hash-difference recipe (stored hashes must match): (column, type, default), as in the reference view
HASHDIFF_PARTS = [
    ("Crimes_total", "int", 0),
    ("Crimes_monthly", "int", 0),
    ("Frequent_crime_types", "string", "NULL"),
    ("Lat", "decimal(37,15)", 0.0),
    ("Lng", "decimal(37,15)", 0.0),
]


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def _ts(load_ts) -> F.Column:
    if load_ts is None:
        return F.localtimestamp()
    return F.lit(load_ts).cast("timestamp_ntz")


def new_file_rows(stage: DataFrame, log: DataFrame, source: str = SOURCE,
                  file_name: str = FILE_NAME, load_ts=None) -> DataFrame:
    """Rows to append to the file log: one row when the stage is not empty and
    the log has no row for ``(source, file_name)`` yet, else none.

    ``FILE_ID`` continues the log's maximum (auto increment).
    """
    # one pass over the (small) log: the next id, and whether this file is
    # logged already (LEFT JOIN log ON constants WHERE log.FILE_ID IS NULL);
    # of the stage only its first row is looked for
    this_file = (F.col("SOURCE") == source) & (F.col("FILE_NAME") == file_name)
    st = one_row(log.agg((F.coalesce(F.max("FILE_ID"), F.lit(0)) + 1).cast("long").alias("next_id"),
                         F.max(this_file.cast("int")).alias("logged")))
    row = stage.sparkSession.range(1).select(F.lit(st["next_id"]).cast("long").alias("FILE_ID"),
                                             F.lit(source).alias("SOURCE"), F.lit(file_name).alias("FILE_NAME"),
                                             _ts(load_ts).alias("LOAD_TS"))
    return row.limit(0) if st["logged"] == 1 or stage.isEmpty() else row


def latest_files(log: DataFrame) -> DataFrame:
    """Latest log row per ``(SOURCE, FILE_NAME)`` by ``LOAD_TS`` (tie: FILE_ID)."""
    return latest_per_key(log, ["SOURCE", "FILE_NAME"], ["LOAD_TS", "FILE_ID"])


def current_file(log: DataFrame, source: str = SOURCE, file_name: str = FILE_NAME) -> DataFrame:
    """``(FILE_ID, LOAD_TS)`` of the latest row of one file: at most one row."""
    return (latest_files(log.filter((F.col("SOURCE") == source) & (F.col("FILE_NAME") == file_name)))
            .select("FILE_ID", "LOAD_TS"))


_LOOKUP = object()


def current_file_row(log: DataFrame, source: str = SOURCE, file_name: str = FILE_NAME) -> dict | None:
    """``{"FILE_ID", "LOAD_TS"}`` of the current file, read once (one row)."""
    return one_row(current_file(log, source, file_name))


def with_current_file(df: DataFrame, log: DataFrame, source: str = SOURCE,
                      file_name: str = FILE_NAME, file_row=_LOOKUP) -> DataFrame:
    """``df`` with the current file's ``FILE_ID`` and ``LOAD_TS`` attached.

    The reference writes this as an inner join on constants with the latest
    log row.  That row is read as scalars (the log is a small metadata
    table; pass ``file_row`` to reuse one lookup across steps) and attached
    as literals; with no such row the result is empty, as the inner join
    would be.
    """
    row = current_file_row(log, source, file_name) if file_row is _LOOKUP else file_row
    if row is None:
        return df.withColumn("FILE_ID", F.lit(None).cast("long")) \
                 .withColumn("LOAD_TS", F.lit(None).cast("timestamp_ntz")).limit(0)
    return df.withColumn("FILE_ID", F.lit(row["FILE_ID"]).cast("long")) \
             .withColumn("LOAD_TS", F.lit(row["LOAD_TS"]).cast("timestamp_ntz"))


def ods_delta(stage: DataFrame, log: DataFrame, ods: DataFrame,
              source: str = SOURCE, file_name: str = FILE_NAME, file_row=_LOOKUP) -> DataFrame:
    """Stage rows of the current file not yet in the ODS on ``(FILE_ID, District)``."""
    src = with_current_file(stage, log, source, file_name, file_row)
    delta = anti_join(src, ods, ["FILE_ID", "District"])
    return delta.select("FILE_ID", "LOAD_TS", *STAGE_COLUMNS)


def hub_delta(stage: DataFrame, log: DataFrame, hub: DataFrame,
              source: str = SOURCE, file_name: str = FILE_NAME, file_row=_LOOKUP) -> DataFrame:
    """New business keys: ``(HK_DISTRICT, FILE_ID, LOAD_TS, DISTRICT)``."""
    keys = stage.select(hash_key("District").alias("HK_DISTRICT"), F.col("District").alias("DISTRICT"))
    src = with_current_file(keys, log, source, file_name, file_row) \
        .select("HK_DISTRICT", "FILE_ID", "LOAD_TS", "DISTRICT").distinct()
    return anti_join(src, hub, ["HK_DISTRICT"])


def satellite_rows(stage: DataFrame) -> DataFrame:
    return stage.select(
        hash_key("District").alias("HK_DISTRICT"),
        hashdiff(HASHDIFF_PARTS).alias("HASHDIFF"),
        F.col("Crimes_total").alias("CRIMES_TOTAL"),
        F.col("Crimes_monthly").alias("CRIMES_MONTHLY"),
        F.col("Frequent_crime_types").alias("FREQUENT_CRIME_TYPES"),
        F.col("Lat").cast("decimal(37,15)").alias("LAT"),
        F.col("Lng").cast("decimal(37,15)").alias("LNG"),
    )


SAT_COLUMNS = ["HK_DISTRICT", "FILE_ID", "LOAD_TS", "ROW_LOAD_TS", "LOAD_SEQ", "HASHDIFF", "CRIMES_TOTAL",
               "CRIMES_MONTHLY", "FREQUENT_CRIME_TYPES", "LAT", "LNG"]


def sat_delta(stage: DataFrame, log: DataFrame, sat: DataFrame,
              source: str = SOURCE, file_name: str = FILE_NAME, file_row=_LOOKUP, row_load_ts=None) -> DataFrame:
    """Satellite rows whose ``(HK_DISTRICT, HASHDIFF)`` is not in the satellite.

    The anti join covers all history, so values returning to an older state
    are not recorded again (reference behaviour).  ``FILE_ID`` and ``LOAD_TS``
    are the file's, logged once however often it is loaded; ``ROW_LOAD_TS``
    (default: the file's) and ``LOAD_SEQ``, one more than any in the
    satellite, are the row's own.
    """
    src = with_current_file(satellite_rows(stage), log, source, file_name, file_row)
    seq = one_row(sat.agg((F.coalesce(F.max("LOAD_SEQ"), F.lit(0)) + 1).alias("n")))["n"]
    src = src.withColumn("ROW_LOAD_TS", F.col("LOAD_TS") if row_load_ts is None else _ts(row_load_ts)) \
             .withColumn("LOAD_SEQ", F.lit(seq).cast("long"))
    return anti_join(src, sat, ["HK_DISTRICT", "HASHDIFF"]).select(*SAT_COLUMNS)


def current_view(hub: DataFrame, sat: DataFrame) -> DataFrame:
    """The satellite row loaded last per district (by ``LOAD_SEQ``)."""
    joined = hub.select("HK_DISTRICT", "DISTRICT").join(sat, "HK_DISTRICT", "inner")
    latest = latest_per_key(
        joined.select("DISTRICT", "LOAD_SEQ", "CRIMES_TOTAL", "CRIMES_MONTHLY",
                      "FREQUENT_CRIME_TYPES", "LAT", "LNG"),
        ["DISTRICT"], ["LOAD_SEQ"])
    return latest.select("DISTRICT", "CRIMES_TOTAL", "CRIMES_MONTHLY", "FREQUENT_CRIME_TYPES",
                         "LAT", "LNG")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, or with a null part: ``(*keys, n_rows)``.

    A plain aggregate (partial + final), so a hot key is counted map-side.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    any_null = None
    for k in keys:
        cond = F.col(k).isNull()
        any_null = cond if any_null is None else any_null | cond
    return counts.filter((F.col("n_rows") > 1) | any_null)


def enforce(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Raise when ``keys`` are not unique or ``not_null`` columns hold nulls.

    The check is a bounded action (``isEmpty`` stops at the first hit).
    """
    if keys and not key_violations(df, keys).isEmpty():
        raise ValueError(f"primary key {list(keys)} violated")
    for c in not_null:
        if not df.filter(F.col(c).isNull()).isEmpty():
            raise ValueError(f"NOT NULL column {c} holds nulls")
    return df


# ---------------------------------------------------------------- table chain

# The warehouse's tables, their keys and NOT NULL columns.
ODS_DDL = ("FILE_ID long, LOAD_TS timestamp_ntz, District string, Crimes_total long, "
           "Crimes_monthly long, Frequent_crime_types string, Lat decimal(37,15), Lng decimal(37,15)")
HUB_DDL = "HK_DISTRICT string, FILE_ID long, LOAD_TS timestamp_ntz, DISTRICT string"
SAT_DDL = ("HK_DISTRICT string, FILE_ID long, LOAD_TS timestamp_ntz, ROW_LOAD_TS timestamp_ntz, "
           "LOAD_SEQ long, HASHDIFF string, "
           "CRIMES_TOTAL long, CRIMES_MONTHLY long, FREQUENT_CRIME_TYPES string, "
           "LAT decimal(37,15), LNG decimal(37,15)")
LOG_DDL = "FILE_ID long, SOURCE string, FILE_NAME string, LOAD_TS timestamp_ntz"

# name: columns, key, segmentation, NOT NULL
TABLES = {"file_log": (LOG_DDL, ["FILE_ID", "SOURCE", "FILE_NAME"], ["SOURCE", "FILE_NAME"],
                       ["FILE_ID", "SOURCE", "FILE_NAME", "LOAD_TS"]),
          "ods": (ODS_DDL, ["FILE_ID", "District"], ["District"],
                  ["FILE_ID", "LOAD_TS", "District", "Crimes_total", "Crimes_monthly"]),
          "hub": (HUB_DDL, ["HK_DISTRICT"], ["HK_DISTRICT"], ["HK_DISTRICT", "FILE_ID", "LOAD_TS", "DISTRICT"]),
          "satellite": (SAT_DDL, ["HK_DISTRICT", "HASHDIFF"], ["HK_DISTRICT"],
                        ["HK_DISTRICT", "FILE_ID", "LOAD_TS", "HASHDIFF", "CRIMES_TOTAL", "CRIMES_MONTHLY"])}


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    from riverbend.sources.sinks import create_table_if_absent
    path = f"{root.rstrip('/')}/{name}"
    create_table_if_absent(spark, path, TABLES[name][0])
    return spark.read.schema(TABLES[name][0]).parquet(path)


def checked_rows(name: str, delta: DataFrame, check: bool = True) -> int:
    """The number of rows of a saved delta of the table ``name``; with
    ``check``, raises where its key is not unique or a NOT NULL column holds nulls.

    The key is enforced on the delta alone: every delta is an anti join
    against the stored rows on that key (the log's new id is max + 1), so a
    clash can only come from inside the delta, and the check costs O(delta),
    not a scan of the table."""
    _, key, _, not_null = TABLES[name]
    # one aggregate gives the row count, the nulls and the key check: distinct
    # key tuples equal the rows exactly when keys are unique and never null
    st = one_row(delta.agg(F.count(F.lit(1)).alias("n"),
                           F.count_distinct(*[F.col(k) for k in key]).alias("d"),
                           *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]))
    n = st["n"]
    if n and check:
        nulls = [c for c in not_null if st[f"null_{c}"]]
        if nulls:
            raise ValueError(f"{name}: NOT NULL columns {nulls} hold nulls")
        if st["d"] != n:
            raise ValueError(f"{name}: primary key {key} violated (unique, not null)")
    return n


def _append(spark: SparkSession, root: str, name: str, delta: DataFrame, check: bool) -> int:
    """Append ``delta`` (materialised first: it reads the table it extends)."""
    cluster = TABLES[name][2]
    delta, path = save(delta, f"delta-{name}")
    n = checked_rows(name, delta, check)
    if n:
        # rows hash-distributed and sorted on the segmentation key
        (delta.repartition(*cluster).sortWithinPartitions(*cluster)
              .write.mode("append").parquet(f"{root.rstrip('/')}/{name}"))
    release(spark, path)
    return n


def run_load_chain(stage: DataFrame, root: str, source: str = SOURCE, file_name: str = FILE_NAME,
                   load_ts=None, check_keys: bool = True) -> dict[str, int]:
    """One run of the load: file log, ODS, hub, satellite as parquet tables
    under ``root`` (created when absent).  Returns rows added per table; a
    rerun with the same stage adds nothing.  The stage is computed once."""
    spark = stage.sparkSession
    stage, stage_path = save(stage, "stage")
    added = {}
    log = _table(spark, root, "file_log")
    added["file_log"] = _append(spark, root, "file_log",
                                new_file_rows(stage, log, source, file_name, load_ts), check_keys)
    log = _table(spark, root, "file_log")
    row = current_file_row(log, source, file_name)
    added["ods"] = _append(spark, root, "ods",
                           ods_delta(stage, log, _table(spark, root, "ods"), source, file_name, row),
                           check_keys)
    added["hub"] = _append(spark, root, "hub",
                           hub_delta(stage, log, _table(spark, root, "hub"), source, file_name, row),
                           check_keys)
    added["satellite"] = _append(spark, root, "satellite",
                                 sat_delta(stage, log, _table(spark, root, "satellite"), source,
                                           file_name, row, load_ts),
                                 check_keys)
    release(spark, stage_path)
    return added


def current_from_tables(spark: SparkSession, root: str) -> DataFrame:
    return current_view(_table(spark, root, "hub"), _table(spark, root, "satellite"))
