from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riverbend.functions.hashing import hashdiff
from riverbend.operators import vault

STAGE = ("District string, Crimes_total long, Crimes_monthly long, Frequent_crime_types string, "
         "Lat decimal(37,15), Lng decimal(37,15)")
ODS = ("FILE_ID long, LOAD_TS timestamp_ntz, District string, Crimes_total long, Crimes_monthly long, "
       "Frequent_crime_types string, Lat decimal(37,15), Lng decimal(37,15)")
HUB = "HK_DISTRICT string, FILE_ID long, LOAD_TS timestamp_ntz, DISTRICT string"
SAT = vault.SAT_DDL


def stage(spark, total_b=5):
    return spark.createDataFrame([("A", 10, 2, "x, y", Decimal("1.5"), Decimal("2.5")),
                                  ("B", total_b, 1, None, None, Decimal("0"))], STAGE)


def load(spark, st, state):
    """One run of the chain on in-memory tables: log, ODS, hub, satellite."""
    log, ods, hub, sat = state
    log = log.unionByName(vault.new_file_rows(st, log, load_ts="2024-01-01 00:00:00"))
    ods = ods.unionByName(vault.ods_delta(st, log, ods))
    hub = hub.unionByName(vault.hub_delta(st, log, hub))
    sat = sat.unionByName(vault.sat_delta(st, log, sat))
    return tuple(_freeze(spark, df) for df in (log, ods, hub, sat))


def _freeze(spark, df):
    # materialise through the driver: tiny test tables only
    return spark.createDataFrame(df.collect(), df.schema)


def empty_state(spark):
    return (vault.empty_log(spark), spark.createDataFrame([], ODS),
            spark.createDataFrame([], HUB), spark.createDataFrame([], SAT))


def counts(state):
    return tuple(df.count() for df in state)


def test_rerun_adds_nothing(spark):
    st = stage(spark)
    s1 = load(spark, st, empty_state(spark))
    assert counts(s1) == (1, 2, 2, 2)
    s2 = load(spark, st, s1)
    assert counts(s2) == counts(s1)


def test_changed_metric_adds_one_satellite_row(spark):
    s1 = load(spark, stage(spark), empty_state(spark))
    s2 = load(spark, stage(spark, total_b=6), s1)
    log, ods, hub, sat = (a - b for a, b in zip(counts(s2), counts(s1)))
    assert (log, ods, hub, sat) == (0, 0, 0, 1)
    # the insert-once log gives both B rows the same file id and load time;
    # the view still returns exactly one row per district
    # the view returns the row loaded last
    cur = {r["DISTRICT"]: r["CRIMES_TOTAL"] for r in vault.current_view(s2[2], s2[3]).collect()}
    assert cur == {"A": 10, "B": 6}


def test_file_id_continues_log(spark):
    log = spark.createDataFrame([(7, "ERP", "OTHER", None)],
                                "FILE_ID long, SOURCE string, FILE_NAME string, LOAD_TS timestamp_ntz")
    rows = vault.new_file_rows(stage(spark), log, load_ts="2024-01-01 00:00:00").collect()
    assert [(r["FILE_ID"], r["FILE_NAME"]) for r in rows] == [(8, "STG_OPER")]


def test_hashdiff_has_no_delimiter(spark):
    df = spark.createDataFrame([(1, 23), (12, 3)], "a int, b int")
    h = [r[0] for r in df.select(hashdiff([("a", "int", 0), ("b", "int", 0)])).collect()]
    assert h[0] == h[1]


def test_hashdiff_defaults_text(spark):
    df = spark.createDataFrame([(None, None)], "t string, d decimal(37,15)")
    got = df.select(hashdiff([("t", "string", "NULL"), ("d", "decimal(37,15)", 0.0)]).alias("h"),
                    F.md5(F.lit("NULL0.000000000000000")).alias("e")).collect()[0]
    assert got["h"] == got["e"]


def test_key_enforcement(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k long, v string")
    viol = {r["k"]: r["n_rows"] for r in vault.key_violations(df, ["k"]).collect()}
    assert viol == {1: 2, None: 1}
    with pytest.raises(ValueError):
        vault.enforce(df, ["k"])
    with pytest.raises(ValueError):
        vault.enforce(df.filter("k is null or v = 'a'"), [], not_null=["k"])


def test_table_chain_rerun_and_change(spark, tmp_dir):
    root = tmp_dir + "/dwh"
    first = vault.run_load_chain(stage(spark), root, load_ts="2024-01-01 00:00:00")
    assert first == {"file_log": 1, "ods": 2, "hub": 2, "satellite": 2}
    again = vault.run_load_chain(stage(spark), root, load_ts="2024-01-02 00:00:00")
    assert again == {"file_log": 0, "ods": 0, "hub": 0, "satellite": 0}
    changed = vault.run_load_chain(stage(spark, total_b=6), root, load_ts="2024-01-03 00:00:00")
    assert changed == {"file_log": 0, "ods": 0, "hub": 0, "satellite": 1}
    fallen = vault.run_load_chain(stage(spark, total_b=3), root, load_ts="2024-01-03 00:00:00")
    assert fallen["satellite"] == 1
    assert {r["DISTRICT"]: r["CRIMES_TOTAL"] for r in vault.current_from_tables(spark, root).collect()} == {"A": 10, "B": 3}


def test_table_chain_rejects_null_metrics(spark, tmp_dir):
    bad = stage(spark).withColumn("Crimes_total", F.when(F.col("District") == "A", F.col("Crimes_total")))
    with pytest.raises(ValueError, match="NOT NULL.*Crimes_total"):
        vault.run_load_chain(bad, tmp_dir + "/dwh", load_ts="2024-01-01 00:00:00")


def test_table_chain_rejects_duplicate_stage_keys(spark, tmp_dir):
    dup = stage(spark).unionByName(stage(spark).limit(1).withColumn("Crimes_total", F.lit(99).cast("long")))
    with pytest.raises(ValueError):
        vault.run_load_chain(dup, tmp_dir + "/dwh", load_ts="2024-01-01 00:00:00")
