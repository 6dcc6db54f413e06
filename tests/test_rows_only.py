"""Shape checks for the registered queries that have no SQL oracle."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

from conftest import SF_SMALL


def run(spark, name):
    return entry.queries()[name](spark, SF_SMALL)


def test_grid_search_reports_every_setting_once(spark):
    rows = run(spark, "grid_search").collect()
    assert len(rows) == 18
    assert sorted({(r["max_df"], r["num_trees"], r["max_depth"]) for r in rows}) == sorted(
        (m, t, d) for m in (0.5, 0.75, 1.0) for t in (40, 60, 100) for d in (5, 8))
    assert sum(r["best"] for r in rows) == 1
    best = [r for r in rows if r["best"]][0]
    assert best["mean_accuracy"] == max(r["mean_accuracy"] for r in rows)


def test_scores_cover_every_document(spark):
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    s = run(spark, "lr_scores").agg(F.count("*"), F.countDistinct("doc_id"), F.min("clean_probability"), F.max("clean_probability")).first()
    assert s[0] == s[1] == n_docs and 0.0 <= s[2] <= s[3] <= 1.0


def test_stream_bands_add_up_to_the_documents(spark):
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    rows = run(spark, "rf_stream_bands").collect()
    assert {r["clean_probability"] for r in rows} <= {"positive", "negative", "undefine"}
    assert sum(r["count"] for r in rows) == n_docs


def test_samples_parts(spark):
    rows = run(spark, "samples").collect()
    parts = {}
    for r in rows:
        parts.setdefault(r["part"], []).append(r["doc_id"])
    n_lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet").count()
    assert len(parts["train"]) + len(parts["test"]) == n_lab
    assert not set(parts["train"]) & set(parts["test"])
    assert parts["feed"]
