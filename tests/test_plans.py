"""Plan guards: the shapes that do not survive a large cluster are absent.

* no Cartesian product / nested-loop join (no cross joins),
* no row-at-a-time Python UDF (``BatchEvalPython``),
* per-key aggregations keep a partial (map-side) step before the shuffle,
  so a key holding a third of the rows is combined inside each scan task.
"""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riverbend.operators import joins, keyed, report
from riverbend.plans import catalog, oracle

from conftest import SF_SMALL

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
STREAMS = {"window_append_20_10", "filtered_stream", "cdc_apply_stream", "legacy_type_counts", "typed_change_stream",
           "legacy_live_counts", "window_state_restart", "cdc_redelivered", "record_effects", "newton_stream_bands"}
FAST = sorted(set(catalog.QUERIES) & set(oracle.SQL) - STREAMS)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FAST)
def test_no_cross_join_or_row_udf(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    text = plan_text(df)
    for op in BANNED:
        assert op not in text, f"{name} plan has {op}"


def logged_plans(spark, run):
    """The physical plans of all SQL executions that ``run`` starts: of saved
    intermediate tables and streaming batches too."""
    log = spark.conf.get("spark.eventLog.dir").removeprefix("file:") + "/" + spark.sparkContext.applicationId
    path = next(p for p in (log, log + ".inprogress") if os.path.exists(p))
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    with open(path) as fh:
        fh.seek(0, os.SEEK_END)
        run()
        bus.waitUntilEmpty(60_000)
        events = [json.loads(line) for line in fh if '"physicalPlanDescription"' in line and line.endswith("\n")]
    return [e["physicalPlanDescription"] for e in events]


@pytest.mark.parametrize("name", sorted(STREAMS | {"incident_report", "vault_current", "vault_catalog"}))
def test_no_cross_join_in_any_job(spark, name):
    plans = logged_plans(spark, lambda: entry.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save())
    assert len(plans) > 1
    for plan in plans:
        for op in BANNED:
            assert op not in plan, f"{name} runs a {op}"


def test_hot_key_is_reduced_before_the_shuffle(spark):
    # one key holds a third of the rows
    n = 30000
    df = spark.range(n).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"),
                               F.col("id").alias("ts"), (F.col("id") * 2).alias("v"))
    latest = joins.latest_per_key(df, ["k"], ["ts"])
    latest.write.format("noop").mode("overwrite").save()
    text = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text
    assert latest.filter("k = 7").first()["ts"] == n - 3
    first = keyed.first_by_attr(df.withColumnRenamed("k", "phone").withColumnRenamed("ts", "customer_id")
                                  .withColumnRenamed("v", "ltv"))
    first.write.format("noop").mode("overwrite").save()
    assert "partial_min_by" in first._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_limited_before_the_shuffle(spark):
    counts = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").cast("string").alias("item"),
                                      F.col("id").alias("c"))
    out = report.top_k_per_group(counts, "g", "item", "c", 3)
    out.write.format("noop").mode("overwrite").save()
    assert "WindowGroupLimit" in plan_text(out)


def test_hot_join_key_is_split_by_aqe(spark):
    """A lookup where one key holds a third of the requests: with broadcast
    off, AQE splits the skewed shuffle partition of the sort-merge join."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60000
        requests = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("customer_id"),
            F.col("id").alias("request_id"))
        table = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") + 1).alias("ltv"))
        out = keyed.lookup_by_id(table, requests)
        rows = out.collect()          # runs this DataFrame's own adaptive plan
        assert len(rows) == n and all(r["ltv"] == r["customer_id"] + 1 for r in rows)
        assert "skew=true" in plan_text(out)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
