"""Schemas of variants, sums in a state store, restarts and redelivered messages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from riverbend.plans import tables as tb
from riverbend.session import settings
from riverbend.sources.readers import file_stream
from riverbend.streaming import cdc, consumers, legacy, runner, state

from conftest import SF_SMALL

FEED = "value string, arrived timestamp"


def messages(spark, texts, at=None):
    rows = [(t, i if at is None else at[i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, at long").select("value", F.timestamp_seconds("at").alias("arrived"))


def look(batch):
    rows, seen = legacy.observed(batch)
    rows.write.format("noop").mode("overwrite").save()
    return legacy.inferred(seen)


def test_merged_schema_of_a_batch(spark):
    found = look(messages(spark, ['{"bot": false, "n": 1}', '{"bot": true, "x y": {"OBJECT<b": [1, 2]}, "n": 2.5}', None]))
    assert found.columns.keys() == {"bot", "n", "x y"}
    assert found.columns["bot"].simpleString() == "boolean" and found.columns["n"].simpleString().startswith("decimal")
    assert found.columns["x y"].fieldNames() == ["OBJECT<b"]
    assert found.malformed == 0


@pytest.mark.parametrize("texts, malformed", [([], 0), ([None], 0), (["", "oops", "[1]", "3", '{"a": 1, "a": 2}', "null"], 6), (["{}"], 0)])
def test_batches_without_columns(spark, texts, malformed):
    found = look(messages(spark, texts))
    assert found.columns == {} and found.malformed == malformed
    assert legacy.batch_type_counts(messages(spark, texts)).count() == 0


def test_malformed_messages_are_counted_and_left_out(spark):
    good = ['{"bot": false, "type": "a"}'] * 3 + ['{"bot": true, "type": "a"}', '{"bot": "maybe", "type": "a"}', '{"bot": null, "type": "a"}',
                                                  '{"bot": false}', '{"bot": false, "type": 142}', '{"bot": false, "type": 7}']
    batch = messages(spark, [*good, "[]", "{", '[{"bot": false, "type": "a"}]'], at=[0] * 12)
    assert look(batch).malformed == 3
    assert {(r["type"], r["count"]) for r in legacy.batch_type_counts(batch).collect()} == {("a", 3), ("7", 1)}


def test_a_message_is_parsed_once_and_no_text_written(spark, tmp_dir):
    from test_plans import logged_plans
    batch = messages(spark, ['{"bot": false, "type": "a"}'] * 5)
    batch.write.parquet(os.path.join(tmp_dir, "in"))
    batch = spark.read.parquet(os.path.join(tmp_dir, "in"))
    plans = logged_plans(spark, lambda: legacy.write_batch_counts(batch, 0, os.path.join(tmp_dir, "out")))
    parsing = [p for p in plans if "parseJson" in p and "isFinalPlan=true" in p]
    assert len(parsing) == 1 and not any("from_json" in p or "Execute InsertIntoHadoopFsRelationCommand" in p and ", Text," in p for p in plans)
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).agg(F.sum("count")).first()[0] == 5


def test_a_batch_run_again_replaces_its_counts(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "sink")
    for _ in range(2):
        legacy.write_batch_counts(messages(spark, ['{"bot": false, "type": "a"}'] * 5), 3, sink)
    legacy.write_batch_counts(messages(spark, ['{"kind": 1}']), 4, sink)
    assert [tuple(r) for r in spark.read.parquet(sink).select("type", "count", "batch_id").collect()] == [("a", 5, 3)]


def append(spark, feed, texts, at):
    messages(spark, texts, at).coalesce(1).write.mode("append").parquet(feed)
    return file_stream(spark, feed, FEED, fmt="parquet", max_files_per_trigger=None)


def test_live_sums_equal_the_batch_sums_after_every_part(spark, tmp_dir):
    feed, live, seen = os.path.join(tmp_dir, "feed"), legacy.LiveSums(spark, os.path.join(tmp_dir, "live")), []
    for k in range(3):
        at = [200 * k + 7 * i for i in range(30)]
        texts = [json.dumps({"bot": i % 5 == 0, "type": "ab"[i % 2]}) for i in range(30)]
        seen += zip(texts, at, strict=True)
        live.advance(append(spark, feed, texts, at))
        counts = legacy.batch_type_counts(messages(spark, [t for t, _ in seen], [a for _, a in seen]))
        assert sorted(map(tuple, live.table().collect())) == sorted(map(tuple, legacy.windowed_type_counts(counts).collect()))


def test_the_state_of_live_sums_is_bounded(spark, tmp_dir):
    feed, live = os.path.join(tmp_dir, "feed"), legacy.LiveSums(spark, os.path.join(tmp_dir, "live"))
    for k in range(4):
        live.advance(append(spark, feed, ['{"bot": false, "type": "a"}'] * 10, [10_000 * k + i for i in range(10)]))
    held = spark.read.format("statestore").load(f"{live.root}/sums-checkpoint")
    # windows of the last part, and of the one before until the watermark has passed them
    assert 0 < held.count() <= 2 * 31 < live.table().count()


def test_sums_appear_while_the_stream_runs(spark, tmp_dir):
    import time
    feed, live = os.path.join(tmp_dir, "feed"), legacy.LiveSums(spark, os.path.join(tmp_dir, "live"))
    text = ['{"bot": false, "type": "a"}'] * 10
    live.advance(append(spark, feed, text, range(10)))
    stream = append(spark, feed, text, range(400, 410))
    queries = [live.start_counts(stream, trigger={"processingTime": "200 milliseconds"}), live.start_sums({"processingTime": "200 milliseconds"})]
    try:
        for _ in range(300):
            if live.table().agg(F.max("window_end")).first()[0].timestamp() > 650:
                break
            time.sleep(0.2)
        assert all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.stop()
    assert live.table().where("count = 10").count() >= 58


def window_feed(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")

    def put(at):
        rows = spark.createDataFrame([("edit", False, t) for t in at], "type string, bot boolean, t long")
        rows = rows.select("type", "bot", F.timestamp_seconds("t").alias("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(feed)
        return consumers.window_counts(file_stream(spark, feed, rows.schema, fmt="parquet", max_files_per_trigger=None))
    return put


def test_a_query_stopped_in_a_window_resumes_with_its_state(spark, tmp_dir):
    put, root = window_feed(spark, tmp_dir), os.path.join(tmp_dir, "windows")

    def starts(rows):
        return sorted((r.second, r["count"]) for r in rows.select(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("second"), "count").collect())

    state.run_windows(put([1, 2, 15, 31]), root)
    assert starts(state.open_windows(spark, root)) == [(0, 3), (10, 1), (20, 1), (30, 1)]
    state.run_windows(put([33, 70]), root)  # the window from 30 on goes on counting
    assert starts(state.closed_windows(spark, root)) == [(-10, 2), (0, 3), (10, 1), (20, 2), (30, 2)]
    assert starts(state.open_windows(spark, root)) == [(60, 1), (70, 1)]
    names = [f for _, _, files in os.walk(os.path.join(root, "checkpoint", "state")) for f in files]
    assert any(f.endswith((".changelog", ".zip")) for f in names)  # RocksDB's own files


def test_settings_come_back(spark):
    key, other = "spark.sql.shuffle.partitions", "spark.riverbend.test"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), settings(spark, {key: "3", other: "x"}):
        assert spark.conf.get(key) == "3" and spark.conf.get(other) == "x"
        raise KeyError
    assert spark.conf.get(key) == before and spark.conf.get(other, None) is None
    with state.rocksdb(spark):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_redelivered_messages_are_dropped_and_none_else(spark, tmp_dir):
    feed, out = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out")
    place = lambda lsn, **more: json.dumps({"payload": {"source": {"lsn": lsn}, **more}})
    first = [("a", place(1), 1), ("a", place(1), 2), ("b", place(1), 3), ("a", place(2), 4), ("c", "no json", 5), ("c", "no json", 6),
             ("c", "other", 7), ("d", None, 8), ("d", None, 9), ("e", place(None, op="c"), 10), ("e", place(None, op="d"), 11)]
    again = [*first, ("a", place(3), 12)]
    from riverbend.sources.sinks import start_stream
    for rows in (first, again):
        spark.createDataFrame(rows, "key string, value string, offset long").coalesce(1).write.mode("append").json(feed)
        stream = file_stream(spark, feed, "key string, value string, offset long", max_files_per_trigger=None)
        runner.await_query(start_stream(cdc.once(stream), f"{out}-chk", out))
    found = sorted((r.key, r.value or "") for r in spark.read.parquet(out).collect())
    assert found == sorted([("a", place(1)), ("b", place(1)), ("a", place(2)), ("c", "no json"), ("c", "other"), ("d", ""),
                            ("e", place(None, op="c")), ("e", place(None, op="d")), ("a", place(3))])


def test_counts_of_applied_messages_survive_compaction(spark, tmp_dir):
    msgs = tb.cdc_messages(tb.Tables(spark, SF_SMALL))
    writer = cdc.make_batch_writer(tmp_dir, compact_partitions=1)
    for k in range(3):
        writer(msgs.where(F.col("offset") % 3 == k), k)
    want = cdc.change_rows(msgs).groupBy("id").count()
    assert sorted(map(tuple, cdc.applied(spark, tmp_dir).collect())) == sorted(map(tuple, want.collect()))
