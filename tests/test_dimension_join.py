import json
import os

import pytest
from pyspark.sql import functions as F

from riverbend.operators import joins
from riverbend.session import settings
from test_warehouse import NO_BROADCAST


def tables(spark, facts=20_000, keys=1000, kept=20):
    dim = spark.range(kept).select((F.col("id") * 37 % keys).alias("k"), F.col("id").alias("name"))
    return spark.range(facts).select((F.col("id") % keys).alias("fk"), F.col("id").alias("v")), dim


def shuffled_rows(spark, run):
    """Rows written to shuffles by the tasks that ``run`` starts."""
    log = spark.conf.get("spark.eventLog.dir").removeprefix("file:") + "/" + spark.sparkContext.applicationId
    path = next(p for p in (log, log + ".inprogress") if os.path.exists(p))
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    with open(path) as fh:
        fh.seek(0, os.SEEK_END)
        run()
        bus.waitUntilEmpty(60_000)
        tasks = [json.loads(line) for line in fh if line.startswith('{"Event":"SparkListenerTaskEnd"') and line.endswith("\n")]
    return sum(t["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"] for t in tasks)


def test_no_key_of_the_dimension_is_lost(spark):
    for n in (0, 1, 7, 5000):
        dim = spark.range(n).select((F.col("id") * 1_000_003).alias("k"))
        may_have = joins.key_filter(dim, "k")
        assert dim.where(may_have(F.col("k"))).count() == n
        others = spark.range(20_000).select((F.col("id") * 1_000_003 + 1).alias("k"))
        assert others.where(may_have(F.col("k"))).count() < 200  # of which about 0.3 %


def test_null_keys_and_copies(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, x int")
    facts = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "fk string, v int")
    for limit in (0, 1 << 20):
        rows = joins.dimension_join(facts, dim, "fk", "k", replicate_bytes=limit).collect()
        assert sorted((r.v, r.x) for r in rows) == [(1, 1), (1, 2)]
    assert joins.dimension_join(facts, dim.limit(0), "fk", "k", replicate_bytes=-1).count() == 0


def test_keys_of_different_types_match(spark):
    facts = spark.createDataFrame([(1,), (2,)], "fk int")
    dim = spark.createDataFrame([(2,), (3,)], "k long")
    assert [r.fk for r in joins.dimension_join(facts, dim, "fk", "k", replicate_bytes=0).collect()] == [2]


def test_all_ways_give_the_same(spark):
    facts, dim = tables(spark)
    want = sorted(map(tuple, facts.join(dim, facts.fk == dim.k).collect()))
    for more in ({}, {"replicate_bytes": 0}, {"replicate_bytes": 0, "max_bits": 1}):
        assert sorted(map(tuple, joins.dimension_join(facts, dim, "fk", "k", **more).collect())) == want


def test_fewer_facts_are_shuffled(spark):
    facts, dim = tables(spark)
    with settings(spark, NO_BROADCAST):
        run = lambda **more: shuffled_rows(spark, lambda: joins.dimension_join(facts, dim, "fk", "k", replicate_bytes=0, **more).write.format("noop").mode("overwrite").save())  # noqa: E731,E501
        whole, thinned = run(max_bits=0), run()
    assert whole >= 20_000 and thinned < 2_000


def test_the_size_is_measured(spark):
    small, large = spark.range(10), spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert 0 < joins.measured_bytes(small) < 1000 < 10_000 < joins.measured_bytes(large)
    assert joins.measured_bytes(small.limit(0)) == 0
    facts = spark.range(100)
    with settings(spark, NO_BROADCAST):
        plan = lambda dim: facts.join(dim, "id")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(joins.replicated(small)) and "BroadcastHashJoin" not in plan(joins.replicated(small, max_bytes=10))


def test_the_filter_is_sized_by_count(spark):
    assert joins.key_filter(spark.range(1000), "id", max_bits=1000) is None
    assert joins.key_filter(spark.range(1000).select((F.col("id") % 10).alias("k")), "k", max_bits=1000) is not None


@pytest.mark.parametrize("bits", [64, 3136, 1 << 26])
def test_places_lie_in_the_filter(spark, bits):
    got = spark.range(200).select(F.explode(F.array(*joins._places(F.col("id"), bits))).alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0 <= got[0] <= got[1] < bits
