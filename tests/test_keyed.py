from pyspark.sql import functions as F

from riverbend.operators import keyed


def store(spark, n=1000):
    # keys 0..n-1, phone = id (stored as text), ltv = id + 1
    return spark.range(n).select(F.col("id").alias("customer_id"),
                                 F.col("id").cast("string").alias("phone"),
                                 (F.col("id") + 1).alias("ltv"))


def test_thousand_lookups_by_id_and_phone(spark):
    table = store(spark)
    req = spark.range(1000).select(F.col("id").alias("customer_id"))
    by_id = keyed.lookup_by_id(table, req)
    assert by_id.filter(F.col("ltv") == F.col("customer_id") + 1).count() == 1000
    # the request carries the phone as a number: both sides compare as text
    req_phone = spark.range(1000).select(F.col("id").alias("phone"))
    by_phone = keyed.lookup_by_attr(table, req_phone)
    assert by_phone.filter(F.col("ltv") == F.col("phone") + 1).count() == 1000


def test_missing_key_gives_null(spark):
    table = store(spark, 3)
    req = spark.createDataFrame([(1,), (99,)], "customer_id long")
    got = {r["customer_id"]: r["ltv"] for r in keyed.lookup_by_id(table, req).collect()}
    assert got == {1: 2, 99: None}


def test_first_match_by_attribute(spark):
    table = spark.createDataFrame([(5, "555", 50), (2, "555", 20), (3, "777", 30)],
                                  "customer_id long, phone string, ltv long")
    req = spark.createDataFrame([("555",), ("000",)], "phone string")
    got = {r["phone"]: r["ltv"] for r in keyed.lookup_by_attr(table, req).collect()}
    assert got == {"555": 20, "000": None}


def test_create_update_delete_in_one_batch(spark):
    ch = spark.createDataFrame([(1, 1, 1, "c", "a"), (1, 2, 2, "u", "b"), (1, 3, 3, "d", None),
                                (2, 1, 4, "c", "z")],
                               "id long, ts long, seq long, op string, v string")
    out = keyed.apply_changes(ch, ["id"], ["ts", "seq"]).collect()
    assert [(r["id"], r["v"]) for r in out] == [(2, "z")]


def test_apply_changes_on_current_and_upsert(spark):
    cur = spark.createDataFrame([(1, 0, 0, "c", "old"), (3, 0, 0, "c", "keep")],
                                "id long, ts long, seq long, op string, v string")
    ch = spark.createDataFrame([(1, 5, 1, "u", "new")], "id long, ts long, seq long, op string, v string")
    got = sorted((r["id"], r["v"]) for r in keyed.apply_changes(ch, ["id"], ["ts", "seq"], current=cur).collect())
    assert got == [(1, "new"), (3, "keep")]
    twice = ch.unionByName(spark.createDataFrame([(1, 9, 2, "u", "newer"), (7, 1, 3, "c", "x"), (7, 1, 2, "c", "y")], ch.schema))
    up = keyed.upsert(cur, twice, ["id"], ["ts", "seq"]).collect()
    assert sorted((r["id"], r["v"]) for r in up) == [(1, "newer"), (3, "keep"), (7, "x")]
    up = keyed.upsert(cur, ch, ["id"]).collect()
    assert sorted((r["id"], r["v"]) for r in up) == [(1, "new"), (3, "keep")]
