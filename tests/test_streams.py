import json
import os
import time

import pytest
from pyspark.sql import functions as F

from riverbend.operators import keyed, records, windows
from riverbend.plans import tables as tb
from riverbend.sources.readers import file_stream, table_stream
from riverbend.streaming import cdc, consumers, runner

from conftest import SF_SMALL


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as fh:
            for r in rows:
                fh.write(json.dumps(r) + "\n")
        os.utime(p, (now + i, now + i))


def test_late_rows_judged_by_previous_watermark(spark, tmp_dir):
    batches = [[100], [10, 200], [15, 185, 300], [400]]
    _write_batches(tmp_dir, [[{"type": "edit", "bot": False, "timestamp": t} for t in b]
                             for b in batches])
    stream = file_stream(spark, tmp_dir, "type string, bot boolean, timestamp long",
                         fmt="json", max_files_per_trigger=1)
    typed = stream.select("type", "bot", F.col("timestamp").cast("timestamp").alias("timestamp"))
    counts = consumers.window_counts(consumers.non_bot_changes(typed))
    out = runner.read_table(spark, runner.run_to_table(counts, "late-test"))
    got = sorted((int(r["load_dttm"]["start"].timestamp()), r["count"]) for r in out.collect())
    assert got == [(s, 1) for s in (0, 10, 90, 100, 170, 180, 190, 200, 290, 300)]


def test_stream_equals_batch_over_closed_windows(spark):
    stream = tb.change_events_of(table_stream(spark, SF_SMALL, "events"))
    counts = consumers.window_counts(consumers.non_bot_changes(stream))
    got = consumers.flatten_window(runner.read_table(spark, runner.run_to_table(counts, "eq-test")))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ne = ev.filter(F.col("event_type") != "error").select("ts", F.col("event_type").alias("type"))
    wm = ne.agg(F.max("ts")).first()[0]
    batch = windows.sliding_counts(ne, "ts", 20, 10, ["type"])
    import datetime
    batch = batch.filter(F.col("window_end") <= F.lit(wm - datetime.timedelta(seconds=20)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_type_filter_drops_nulls_and_142(spark):
    df = spark.createDataFrame([(None, False), ("142", False), ("edit", False), ("edit", None)],
                               "type string, bot boolean")
    assert [(r["type"], r["count"]) for r in consumers.guarded_type_counts(df).collect()] == [("edit", 1)]


def test_guard_without_column_is_empty(spark):
    df = spark.createDataFrame([("edit",)], "type string")
    assert consumers.guarded_type_counts(df).count() == 0


def test_json_malformed_and_null(spark):
    df = spark.createDataFrame([("not json",), (None,), ('{"a": 1}',)], "value string")
    schema = records.T.StructType([records.T.StructField("a", records.T.LongType())])
    rows = records.parse_json(df, schema).collect()
    # the null text is filtered out; the malformed one becomes a struct of nulls
    assert sorted((r["a"] is None, r["a"]) for r in rows) == [(False, 1), (True, None)]


def envelope(op, before=None, after=None, ts=5, **source):
    return json.dumps({"payload": {"before": before, "after": after, "op": op, "ts_ms": ts,
                                   "source": {"table": "people", **source}}})


def person(i, name="Ada"):
    return {"id": i, "first_name": name, "last_name": "Byte", "email": f"{name.lower()}@example.org"}


def test_cdc_message(spark):
    df = spark.createDataFrame([(envelope("c", after=person(7), txId=31, lsn=900, snapshot=False),)], "value string")
    r = records.parse_cdc(df).collect()[0]
    assert (r["op"], r["after_id"], r["before_id"], r["source_txid"], r["source_lsn"], r["source_snapshot"]) == ("c", 7, None, 31, 900, False)


def test_cdc_stream_is_order_independent(spark, tmp_dir):
    msgs = tb.cdc_messages(tb.Tables(spark, SF_SMALL))
    rows = [r.asDict() for r in msgs.collect()]
    # newest changes first: batches arrive in reverse time order
    chunks = [rows[i:i + 1000] for i in range(0, len(rows), 1000)][::-1]
    _write_batches(tmp_dir, chunks)
    stream = file_stream(spark, tmp_dir, "key string, value string, offset long", fmt="json", max_files_per_trigger=1)
    root = os.path.join(tmp_dir, "state")
    cdc.apply_stream(stream, root)
    got = sorted(map(tuple, cdc.current_table(spark, root).collect()))
    ch = cdc.change_rows(msgs)
    want = keyed.apply_changes(ch, ["id"], cdc.ORDER).select("id", "first_name", "last_name", "email")
    assert got == sorted(map(tuple, want.collect())) and got


def test_cdc_delete_in_the_transaction_of_an_update(spark, tmp_dir):
    same = {"ts": 9, "txId": 4}
    messages = [envelope("r", after=person(1), ts=1, snapshot=True), envelope("u", person(1), person(1, "Bo"), lsn=20, **same),
                envelope("d", person(1, "Bo"), lsn=21, **same), envelope("r", after=person(2), ts=1, snapshot=True),
                envelope("u", person(3), person(3, "Cy"), **same), envelope("d", person(3), **same)]
    for order in (messages, messages[::-1]):
        df = spark.createDataFrame([(m,) for m in order], "value string")
        assert [r["id"] for r in cdc.last_changes(cdc.change_rows(df)).where("op <> 'd'").collect()] == [2]


def test_cdc_second_run_on_one_root_keeps_the_first(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "root")
    schema = "value string, offset long"
    for run, i in enumerate((1, 2)):
        os.makedirs(src, exist_ok=True)
        with open(os.path.join(src, f"part-{run}.json"), "w") as fh:
            fh.write(json.dumps({"value": envelope("c", after=person(i), lsn=run), "offset": run}) + "\n")
        cdc.apply_stream(file_stream(spark, src, schema), root)
    assert sorted(r["id"] for r in cdc.current_table(spark, root).collect()) == [1, 2]


def test_cdc_read_errors_are_not_hidden(spark, tmp_dir):
    assert cdc.current_table(spark, tmp_dir + "/none").count() == 0
    folder = os.path.join(tmp_dir, "changes", "query_id=q", "batch_id=0")
    os.makedirs(folder)
    with open(os.path.join(folder, "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        cdc.current_table(spark, tmp_dir).collect()


def test_filtered_projection(spark):
    df = spark.createDataFrame([(1, "en", "u", "p", "d", False), (2, "ru", "u", "p", "d", False),
                                (3, "ru", "u", "p", "d", True), (4, None, "u", "p", "d", False)],
                               "CREATEDAT long, CHANNEL string, USERNAME string, WIKIPAGE string, "
                               "DIFFURL string, ISBOT boolean")
    out = consumers.filtered_projection(df, "en")
    assert out.columns == list(consumers.LANG_FIELDS)
    assert [r["CREATEDAT"] for r in out.collect()] == [2]


def test_arrival_window_sums(spark):
    df = spark.createDataFrame([("a", 2, "2024-01-01 00:00:05"), ("a", 3, "2024-01-01 00:00:15")],
                               "type string, count long, load_dttm string")
    out = consumers.arrival_window_sums(df.withColumn("load_dttm", F.col("load_dttm").cast("timestamp")),
                                        length="20 seconds", slide="10 seconds")
    got = sorted((r["window"]["start"].second, r["count"]) for r in out.collect())
    assert got == [(0, 5), (10, 3), (50, 2)]


def test_restart_from_checkpoint_reads_only_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write_batches(src, [[{"type": "a", "bot": False, "timestamp": 1}]])
    schema = "type string, bot boolean, timestamp long"
    chk, out = os.path.join(tmp_dir, "chk"), os.path.join(tmp_dir, "out")
    from riverbend.sources.sinks import start_stream
    runner.await_query(start_stream(file_stream(spark, src, schema), chk, out))
    # new file arrives; the restarted query resumes from its checkpoint
    with open(os.path.join(src, "part-900.json"), "w") as fh:
        fh.write(json.dumps({"type": "b", "bot": False, "timestamp": 2}) + "\n")
    runner.await_query(start_stream(file_stream(spark, src, schema), chk, out))
    assert sorted(r["type"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_memory_sink_and_typed_json_stream(spark, tmp_dir):
    msgs = [{"key": None, "value": json.dumps({"bot": False, "type": "edit", "timestamp": 5,
                                               "meta": {"domain": "x"}, "length": {"new": 2, "old": 1}})},
            {"key": None, "value": None}]
    _write_batches(tmp_dir, [msgs])
    stream = file_stream(spark, tmp_dir, "key string, value string", fmt="json")
    typed = records.parse_json(stream, records.CHANGE_EVENT_SCHEMA)
    from riverbend.sources.sinks import start_stream
    q = start_stream(typed, os.path.join(tmp_dir, "chk"), fmt="memory", query_name="typed_changes")
    runner.await_query(q)
    rows = spark.sql("SELECT type, bot, meta.domain AS domain, length.new AS n FROM typed_changes").collect()
    assert [tuple(r) for r in rows] == [("edit", False, "x", 2)]


def test_decode_kv(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b'{"a":1}'))], "key binary, value binary")
    assert tuple(records.decode_kv(df).first()) == ("k", '{"a":1}')


def arrivals(spark, texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, at long").select(
        "value", F.timestamp_seconds("at").alias("arrived"))


def test_legacy_batch_guard_and_clock(spark, tmp_dir):
    from riverbend.streaming import legacy
    good = arrivals(spark, ['{"bot": false,\n "type": "edit"}', '{"bot": true, "type": "edit"}', '{"bot": false, "type": "142"}',
                            '{"bot": false, "type": "edit"}', None, '{"bot": false, "type": "edit"}'])
    rows = legacy.batch_type_counts(good).collect()
    assert sorted((r["type"], r["count"], int(r["load_dttm"].timestamp())) for r in rows) == [("edit", 1, 5), ("edit", 2, 0)]
    assert legacy.batch_type_counts(arrivals(spark, ['{"type": "edit"}'])).count() == 0


def test_legacy_counts_do_not_depend_on_the_batches(spark, tmp_dir):
    from riverbend.streaming import legacy
    texts = [json.dumps({"bot": i % 3 == 0, "type": "ab"[i % 2]}) for i in range(40)]
    sums = []
    for n, files in enumerate((1, 5)):
        path = os.path.join(tmp_dir, str(n))
        arrivals(spark, texts).repartition(files).write.parquet(path)
        stream = file_stream(spark, path, "value string, arrived timestamp", fmt="parquet")
        sums.append(sorted(map(tuple, legacy.windowed_type_counts(legacy.run_legacy_counts(stream)).collect())))
    assert sums[0] == sums[1] and sums[0]


def test_progress_totals_beyond_the_kept_reports(spark, tmp_dir):
    _write_batches(tmp_dir, [[{"type": "a", "bot": False, "timestamp": i}] * (i + 1) for i in range(8)])
    from riverbend.sources.sinks import start_stream
    totals = runner.progress_totals(spark)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        q = start_stream(file_stream(spark, tmp_dir, "type string, bot boolean, timestamp long"),
                         os.path.join(tmp_dir, "chk"), os.path.join(tmp_dir, "out"))
        runner.await_query(q)
        assert len(q.recentProgress) <= 3
        for _ in range(100):  # reports arrive on the listener's thread
            st = totals.of(q)
            if st["total_messages"] == 36:
                break
            time.sleep(0.1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(totals)
    assert st["total_messages"] == 36 and st["batches"] >= 8 and st["last_batch"]


def test_cdc_compaction_keeps_current_table(spark, tmp_dir):
    msgs = tb.cdc_messages(tb.Tables(spark, SF_SMALL))
    root = os.path.join(tmp_dir, "a")
    writer = cdc.make_batch_writer(root, compact_partitions=2)
    parts = [msgs.filter(F.col("offset") % 4 == i) for i in range(4)]
    writer(parts[0], 0)
    writer(parts[1], 1)
    writer(parts[1], 1)     # a retried batch replaces its own rows
    assert len(cdc._partitions(spark, root)) == 2
    writer(parts[2], 2)     # one too many: rewritten as one
    assert len(cdc._partitions(spark, root)) == 1
    writer(parts[3], 3)
    want = cdc.last_changes(cdc.change_rows(msgs)).where("op <> 'd'").select("id", "first_name", "last_name", "email")
    got = sorted(map(tuple, cdc.current_table(spark, root).collect()))
    assert got == sorted(map(tuple, want.collect())) and got


def test_legacy_empty_batch_counts_nothing(spark):
    from riverbend.streaming import legacy
    empty = spark.createDataFrame([], "value string, arrived timestamp")
    assert legacy.batch_type_counts(empty).count() == 0


def test_console_sink_and_await_any(spark, tmp_dir):
    _write_batches(tmp_dir, [[{"type": "a", "bot": False, "timestamp": 1}]])
    from riverbend.sources.sinks import start_stream
    src = file_stream(spark, tmp_dir, "type string, bot boolean, timestamp long")
    q1 = start_stream(src, os.path.join(tmp_dir, "c1"), fmt="console")
    q2 = start_stream(src, os.path.join(tmp_dir, "c2"), fmt="memory", query_name="await_any_out")
    runner.await_any(spark, 120)
    runner.await_query(q1)
    runner.await_query(q2)
    spark.streams.resetTerminated()
    assert spark.sql("SELECT count(*) FROM await_any_out").first()[0] == 1


def test_table_stream_from_a_folder_of_parts(spark, tmp_dir):
    root = os.path.join(tmp_dir, "sf")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(os.path.join(root, "events.parquet"))
    stream = table_stream(spark, root, "events")
    q = runner.run_to_table(stream.select("event_id"), "parts-test")
    assert spark.read.parquet(q).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
