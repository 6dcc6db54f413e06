import os

import pytest
from pyspark.sql import functions as F

from riverbend.operators.records import json_field_defaults
from riverbend.sources import readers, sinks


def test_csv_header_binds_by_position_and_bad_cell_is_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "w") as fh:
        fh.write("B,A\n1,x\nnot-a-number,y\n")
    df = readers.read_csv(spark, p, "A long, B string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (None, "y")]


def test_csv_without_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "w") as fh:
        fh.write('4,1,Mon,NO_QUERY,bob,"hello world"\n0,2,Tue,NO_QUERY,amy,bye\n')
    schema = "target int, id long, raw_timestamp string, query_status string, author string, tweet string"
    df = readers.read_csv(spark, p, schema, header=False)
    assert df.count() == 2 and df.first()["tweet"] == "hello world"


def test_json_records_fail_fast_and_defaults(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good.json")
    with open(good, "w") as fh:
        fh.write('{"id": 1, "country": "Italy", "points": 87}\n{"id": 2}\n')
    schema = "id decimal(38,0), country string, points decimal(38,0), title string, variety string, winery string"
    df = readers.read_json_records(spark, good, schema)
    filled = json_field_defaults(df, {"country": "empty country", "title": "empty title",
                                      "variety": "empty variety", "winery": "empty winery"})
    rows = {int(r["id"]): r for r in filled.collect()}
    assert rows[2]["country"] == "empty country" and rows[1]["country"] == "Italy"
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as fh:
        fh.write('{"id": 1}\nthis is not json\n')
    with pytest.raises(Exception):
        readers.read_json_records(spark, bad, schema).collect()


def test_inferred_json_from_text_rows(spark):
    texts = spark.createDataFrame([('{"bot": false, "type": "edit"}',), ('{"type": "new"}',)], "value string")
    df = readers.read_json_inferred(spark, texts)
    assert "bot" in df.columns and df.count() == 2


def test_parquet_round_trip_and_single_file(spark, tmp_dir):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    out = os.path.join(tmp_dir, "one")
    sinks.write_parquet(df.repartition(4), out, single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".parquet")]
    assert len(files) == 1
    with pytest.raises(Exception):
        sinks.write_parquet(df, out)          # error if exists
    sinks.write_parquet(df, out, mode="overwrite")
    assert readers.read_parquet(spark, out).count() == 100


def test_json_append_and_clustered_write(spark, tmp_dir):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    j = os.path.join(tmp_dir, "j")
    sinks.write_json(df, j, single_file=True)
    sinks.write_json(df, j, single_file=True)
    assert spark.read.json(j).count() == 20
    c = os.path.join(tmp_dir, "c")
    sinks.write_clustered(df, c, ["k"], partitions=3)
    assert spark.read.parquet(c).count() == 10


def test_create_table_if_absent_and_append(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    sinks.create_table_if_absent(spark, t, "a long, b string")
    sinks.create_table_if_absent(spark, t, "a long, b string")
    sinks.append_into(spark.createDataFrame([(1, "x", 9)], "a long, b string, c long"), t, ["a", "b"])
    assert [tuple(r) for r in spark.read.parquet(t).collect()] == [(1, "x")]


def test_index_documents_mapping(spark):
    df = spark.createDataFrame([(1573400931228, "ru", "u", "p", "d", "k")],
                               "CREATEDAT long, CHANNEL string, USERNAME string, WIKIPAGE string, DIFFURL string, key string")
    out = sinks.index_documents(df, {"CREATEDAT": "date", "WIKIPAGE": "keyword",
                                     "USERNAME": "keyword", "DIFFURL": "text"})
    assert out.columns == ["CREATEDAT", "WIKIPAGE", "USERNAME", "DIFFURL"]
    assert dict(out.dtypes)["CREATEDAT"] == "timestamp"


def test_number_range(spark):
    assert readers.number_range(spark, 1000).agg(F.sum("id")).first()[0] == 499500


def test_create_read_and_drop_a_table(spark, tmp_dir):
    path = tmp_dir + "/schema/t"
    assert sinks.read_or_empty(spark, path, "a long").count() == 0
    sinks.create_table_if_absent(spark, path, "a long")
    sinks.append_into(spark.range(3).selectExpr("id AS a", "id AS b"), path, ["a"])
    sinks.create_table_if_absent(spark, path, "a long")
    assert sinks.read_or_empty(spark, path, "a long").count() == 3
    sinks.drop_table_if_exists(spark, path)
    sinks.drop_table_if_exists(spark, path)
    assert sinks.read_or_empty(spark, path, "a long").count() == 0


def test_csv_keeps_quotes_and_slashes(spark, tmp_dir):
    rows = [(1, 'say "hi", twice'), (2, "back\\slash"), (3, '"')]
    df = spark.createDataFrame(rows, "id long, text string")
    sinks.write_csv(df, tmp_dir + "/c", header=False, quote_all=True)
    got = readers.read_csv(spark, tmp_dir + "/c", "id long, text string", header=False).collect()
    assert sorted(map(tuple, got)) == rows
