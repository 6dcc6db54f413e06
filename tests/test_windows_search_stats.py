import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riverbend.operators import search, stats, windows

from conftest import SF_SMALL


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_two_phase_sliding_equals_window(spark):
    ev = events(spark).select("ts", F.col("event_type").alias("type"))
    got = windows.sliding_counts(ev, "ts", 300, 10, ["type"])
    w = F.window(F.col("ts").cast("timestamp"), "300 seconds", "10 seconds")
    ref = ev.groupBy(w.alias("w"), "type").count().select(
        F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "type", "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def test_uneven_window_falls_back(spark):
    ev = events(spark).select("ts")
    got = windows.sliding_counts(ev, "ts", 25, 10)
    assert got.agg(F.sum("count")).first()[0] >= ev.count()


def test_histogram_matches_numpy(spark):
    ev = events(spark)
    h = {r["bin"]: r["count"] for r in stats.histogram(ev, "value", 10).collect()}
    vals = np.array([r[0] for r in ev.select("value").collect() if r[0] is not None])
    counts, _ = np.histogram(vals, bins=10)
    assert [h[i] for i in range(1, 11)] == list(counts)


def test_terms_top10_brute_force(spark):
    ev = events(spark)
    lo, hi = 1704067200000, 1704067200000 + 5 * 86400 * 1000 - 1
    got = [tuple(r) for r in search.search(ev, must=[search.epoch_millis_range(ev, "ts", lo, hi)],
                                           terms_field="user_id", size=10).collect()]
    pdf = ev.select("user_id", "ts").toPandas()
    ms = (pdf["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(milliseconds=1)
    sel = pdf[(ms >= lo) & (ms <= hi)]
    want = (sel.groupby("user_id").size().reset_index(name="n")
               .sort_values(["n", "user_id"], ascending=[False, True]).head(10))
    assert got == [(int(a), int(b)) for a, b in zip(want["user_id"], want["n"])]


def test_empty_bool_query_matches_all(spark):
    ev = events(spark)
    assert search.search(ev).count() == ev.count()


def test_stream_stats(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:10",)], "t string") \
              .select(F.col("t").cast("timestamp_ntz").alias("ts"))
    r = stats.stream_stats(df, "ts").first()
    assert r["total_messages"] == 2 and abs(r["messages_per_sec"] - 0.2) < 1e-12


def test_bool_query_must_not_and_numeric_range(spark):
    df = spark.createDataFrame([(1, 1000, "a"), (2, 2000, "b"), (3, 3000, None), (4, 4000, "a")],
                               "id long, CREATEDAT long, CHANNEL string")
    rng = search.epoch_millis_range(df, "CREATEDAT", 2000, 4000)
    hits = search.search(df, must=[rng], must_not=[F.col("CHANNEL") == "a"])
    # null channel is not excluded by must_not (no match), as in an index
    assert sorted(r["id"] for r in hits.collect()) == [2, 3]
    top = search.search(df, terms_field="CHANNEL", size=1).collect()
    assert [(r["key"], r["doc_count"]) for r in top] == [("a", 2)]


def test_ms_range_on_timestamps_is_inclusive_at_ms_precision(spark):
    df = spark.createDataFrame([("1970-01-01 00:00:01.000999",), ("1970-01-01 00:00:01.001",)], "t string") \
              .select(F.col("t").cast("timestamp_ntz").alias("ts"))
    got = df.filter(search.epoch_millis_range(df, "ts", 1000, 1000)).count()
    assert got == 1


def test_stream_stats_single_message_has_no_rate(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string") \
              .select(F.col("t").cast("timestamp_ntz").alias("ts"))
    r = stats.stream_stats(df, "ts").first()
    assert r["total_messages"] == 1 and r["messages_per_sec"] is None
