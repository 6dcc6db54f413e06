import pytest
from pyspark.sql import functions as F

from riverbend.functions.scores import band, binary_label, positive_index
from riverbend.operators import text_ml
from riverbend.plans import tables as tb

from conftest import SF_SMALL


def test_band_edges(spark):
    df = spark.createDataFrame([(0.55,), (0.56,), (0.45,), (0.44,)], "p double")
    assert [r[0] for r in df.select(band("p")).collect()] == ["undefine", "positive", "undefine", "negative"]


def test_binary_label(spark):
    df = spark.createDataFrame([(4,), (0,), (None,)], "target int")
    assert [r[0] for r in df.select(binary_label("target")).collect()] == [1, 0, 0]


def test_lr_pipeline_save_reload_and_score(spark, tmp_dir):
    docs = tb.labelled_documents(tb.Tables(spark, SF_SMALL))
    model = text_ml.save_and_reload(text_ml.lr_pipeline().fit(docs), tmp_dir + "/m")
    scored = text_ml.score(model, docs)
    stats = scored.agg(F.count("*"), F.min("clean_probability"), F.max("clean_probability")).first()
    assert stats[0] == docs.count() and 0.0 <= stats[1] <= stats[2] <= 1.0


def test_rf_pipeline_keeps_unseen_and_names_labels(spark):
    docs = tb.labelled_documents(tb.Tables(spark, SF_SMALL))
    model = text_ml.with_label_names(text_ml.rf_pipeline().fit(docs))
    # stream-like input without a label column
    out = model.transform(docs.select("doc_id", "tweet"))
    assert set(r[0] for r in out.select("predictedLabel").distinct().collect()) <= {"0", "1"}


def test_block_scores_cover_every_row(spark):
    t = tb.Tables(spark, SF_SMALL)
    w = text_ml.fit_foreign_model(tb.labelled_documents(t))
    docs = t.documents.select("doc_id", F.col("text").alias("tweet"))
    out = text_ml.block_scores(docs, w)
    s = out.agg(F.count("*"), F.min("proba"), F.max("proba")).first()
    assert s[0] == docs.count() and 0.0 < s[1] <= s[2] < 1.0


def test_samples_are_seeded(spark):
    docs = tb.labelled_documents(tb.Tables(spark, SF_SMALL))
    a = sorted(map(tuple, text_ml.samples(docs, fraction=0.3).collect()))
    b = sorted(map(tuple, text_ml.samples(docs, fraction=0.3).collect()))
    assert a == b
    parts = {p for _, p in a}
    assert {"train", "test"} <= parts


def test_clean_words(spark):
    df = spark.createDataFrame([("Hello, world!! it's 2024 wonderful",)], "tweet string")
    assert text_ml.clean_words(df).first()["tokens"] == ["hello", "world", "wonderful"]


def test_positive_class_is_looked_up(spark):
    docs = spark.createDataFrame([(i, f"text {i} of words", i % 2) for i in range(40)], "doc_id long, tweet string, label int")
    model = text_ml.rf_pipeline().fit(docs)
    assert positive_index(model) == 1 and positive_index(model, 0.0) == 0
    one = text_ml.rf_pipeline().fit(docs.where("label = 1"))
    assert positive_index(one) == 0
    s = text_ml.score(one, docs).select("band").distinct().collect()
    assert [r.band for r in s] == ["positive"]
    with pytest.raises(ValueError, match="label 0"):
        positive_index(one, 0.0)
    with pytest.raises(ValueError, match="label 1"):
        positive_index(text_ml.rf_pipeline().fit(docs.where("label = 0")))


def test_texts_are_hashed_before_the_labels_are_joined(spark):
    t = tb.Tables(spark, SF_SMALL)
    docs = t.documents.select("doc_id", F.col("text").alias("tweet"))
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    model = text_ml.fit_hashed(text_ml.lr_pipeline(), docs, labels)
    direct = text_ml.lr_pipeline().fit(docs.join(labels, "doc_id"))
    a, b = ({r.doc_id: r.clean_probability for r in text_ml.score(m, docs).collect()} for m in (model, direct))
    assert all(abs(a[i] - b[i]) < 1e-3 for i in a)


def test_frequent_terms(spark):
    df = spark.createDataFrame([(["aa", "bb", "aa"],), (["aa"],), (["cc"],), (["aa", "cc"],)], "tokens array<string>")
    assert text_ml.frequent_terms(df, 0.5) == ["aa"] and text_ml.frequent_terms(df, 1.0) == []
    assert [r.tokens for r in text_ml.without_terms(df, ["aa"]).collect()] == [["bb"], [], ["cc"], ["cc"]]


def test_weights_round_trip(spark, tmp_dir):
    import numpy as np
    w = {"w": np.array([0.1, -2.5, 3.0]), "b": np.array([0.7])}
    text_ml.save_weights(spark, w, tmp_dir + "/w")
    again = text_ml.load_weights(spark, tmp_dir + "/w")
    assert (again["w"] == w["w"]).all() and again["b"][0] == 0.7


def test_blocks_do_not_depend_on_the_batches():
    import pandas as pd
    frames = [pd.DataFrame({"a": range(n)}) for n in (3, 0, 25, 1, 10, 1)]
    blocks = list(text_ml.in_blocks(frames, 10))
    assert [len(b) for b in blocks] == [10, 10, 10, 10]
    assert [v for b in blocks for v in b["a"]] == [v for f in frames for v in f["a"]]
    assert list(text_ml.in_blocks([], 10)) == [] and [len(b) for b in text_ml.in_blocks(frames[:1], 10)] == [3]
