import numpy as np
import pytest
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riverbend.operators import forests, text_ml


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        label = int(rng.random() < 0.5)
        own = [f"word{k}" for k in rng.integers(0, 30, 6)] + [f"{'good' if label else 'poor'}{k}" for k in rng.integers(0, 6, int(rng.integers(0, 4)))]
        rows.append((i, float(label), own))
    tokens = spark.createDataFrame(rows, "doc_id long, label double, tokens array<string>")
    vectors = HashingTF(numFeatures=256, inputCol="tokens", outputCol="tf").transform(tokens).cache()
    rf = RandomForestClassifier(labelCol="label", featuresCol="tfidf", seed=3, numTrees=12, maxDepth=6)
    model = Pipeline(stages=[IDF(inputCol="tf", outputCol="w"), Normalizer(p=2.0, inputCol="w", outputCol="tfidf"), rf]).fit(vectors)
    path = str(tmp_path_factory.mktemp("forest") / "rf")
    model.stages[-1].write().save(path)
    return vectors, model, forests.read_forest(spark, path)


def test_the_whole_forest_predicts_as_the_model_does(fitted):
    vectors, model, forest = fitted
    idf = model.stages[0].idf.toArray()
    rows = model.transform(vectors).select("doc_id", F.unwrap_udt("tf").alias("v"), "prediction").orderBy("doc_id").toPandas()
    x = forests.tfidf(rows["v"], idf)
    found = forests.predictions(forest, x, [(12, 6), (12, 0), (1, 6)])
    assert (found[12, 6] == rows["prediction"]).all() and 0.2 < found[12, 6].mean() < 0.8
    first = [t.predict(v) for t in model.stages[-1].trees[:1] for v in (r.tfidf for r in model.transform(vectors).orderBy("doc_id").select("tfidf").collect())]
    assert (found[1, 6] == np.array(first)).all()
    assert len(set(found[12, 0].tolist())) == 1  # roots alone know the classes' shares only


def test_accuracies_are_counted_in_one_job(spark, fitted):
    vectors, model, forest = fitted
    idf = model.stages[0].idf.toArray()
    truth = model.transform(vectors).where("prediction = label").count() / 240
    got = forests.accuracies(vectors.repartition(5), "label", ["tf", "tf"], [(idf, forest), (np.ones(256), forest)], [(0, 12, 6), (1, 3, 2), (0, 1, 0)])
    assert got[0] == pytest.approx(truth) and truth > 0.8 and ((0.3 < got) & (got <= 1)).all()
    assert np.isnan(forests.accuracies(vectors.limit(0), "label", ["tf"], [(idf, forest)], [(0, 12, 6)])).all()


def test_grid_search_tells_settings_apart_and_does_not_depend_on_partitions(spark, monkeypatch):
    for name, value in (("GRID_TREES", (2, 5)), ("GRID_DEPTH", (1, 4)), ("GRID_MAX_DF", (0.5, 1.0)), ("TFIDF_FEATURES", 256), ("GRID_PARTITIONS", 2)):
        monkeypatch.setattr(text_ml, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 5)) + (" lovely weather" if i % 2 and i % 5 else " dreadful weather" if i % 3 else ""))
            for i in range(120)] + [(500, None, "no label here")]
    df = spark.createDataFrame(rows, "doc_id long, label int, tweet string")
    one, best = text_ml.grid_search(df)
    two, _ = text_ml.grid_search(df.repartition(7).orderBy(F.desc("doc_id")))
    one = [tuple(r) for r in one.collect()]
    assert one == [tuple(r) for r in two.collect()] and len(one) == 8 and sum(r[4] for r in one) == 1
    assert max(r[3] for r in one) > 0.75 and len({r[3] for r in one}) > 1
    scored = best.transform(text_ml.clean_words(df.where("label >= 0")))
    assert scored.where("prediction = label").count() / 120 > 0.7


def test_partitions_of_a_fit_grow_with_its_rows(spark, monkeypatch):
    for name, value in (("GRID_TREES", (1, 2)), ("GRID_DEPTH", (1,)), ("GRID_MAX_DF", (1.0,)), ("TFIDF_FEATURES", 64), ("GRID_PARTITIONS", 2)):
        monkeypatch.setattr(text_ml, name, value)
    monkeypatch.setattr(text_ml, "GRID_ROWS", 25, raising=False)
    sizes, fit = [], text_ml.fit_cached
    monkeypatch.setattr(text_ml, "fit_cached", lambda pipe, rows: sizes.append(rows.rdd.glom().map(len).collect()) or fit(pipe, rows))
    for n, parts in ((40, 2), (500, 20)):
        sizes.clear()
        text_ml.grid_search(spark.createDataFrame([(i, i % 2, f"word{i % 3} thing{i % 7}") for i in range(n)], "doc_id long, label int, tweet string"))
        assert len(sizes) == 4 and {len(s) for s in sizes} == {parts} and sum(sizes[-1]) == n and max(map(max, sizes)) <= 50
