import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riverbend.operators import forests, growth, text_ml


def weighted(spark, n, parts, width, classes=2, words=200, empty=False):
    rng = np.random.default_rng(n)
    share = 1 / np.arange(1, words + 1) ** 0.8
    rows = []
    for i in range(n):
        label = int(rng.integers(classes))
        own = [f"word{k}" for k in rng.choice(words, rng.integers(0, 30), p=share / share.sum())] + [f"of{label}and{int(rng.integers(5))}"] * int(rng.random() < 0.4)
        rows.append((i, float(label), [] if empty else own))
    df = spark.createDataFrame(rows, "doc_id long, label double, tokens array<string>").repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    tf = HashingTF(numFeatures=width, inputCol="tokens", outputCol="tf").transform(df).cache()
    return Pipeline(stages=[IDF(inputCol="tf", outputCol="w"), Normalizer(p=2.0, inputCol="w", outputCol="tfidf")]).fit(tf).transform(tf)


def saved(spark, model, path):
    model.write().save(path)
    return sorted(str(r) for r in spark.read.parquet(f"{path}/data").collect())


@pytest.mark.parametrize("n, parts, width, trees, depth, classes, memory, empty", [
    (300, 3, 64, 5, 4, 2, 256, False),
    (1200, 8, 1024, 12, 6, 2, 256, False),
    (700, 3, 256, 6, 5, 3, 1, False),  # several passes a level
    (200, 2, 64, 1, 3, 2, 256, False),  # one tree: all features at every node
    (11_000, 4, 128, 4, 4, 2, 256, False),  # thresholds from a sample
    (26_500, 5, 64, 2, 3, 2, 256, False),  # taken by gaps
    (60, 2, 32, 3, 3, 1, 256, False),  # one class
    (60, 2, 32, 3, 3, 2, 256, True),  # no terms
    (1, 2, 32, 2, 2, 2, 256, False),
])
def test_a_sparse_forest_is_sparks_forest(spark, tmp_path, n, parts, width, trees, depth, classes, memory, empty):
    rows = weighted(spark, n, parts, width, classes, empty=empty)
    settings = RandomForestClassifier(labelCol="label", featuresCol="tfidf", seed=42, numTrees=trees, maxDepth=depth, maxMemoryInMB=memory)
    theirs, ours = settings.fit(rows), growth.SparseForest(settings).fit(rows)
    own = ours.model(spark)
    assert saved(spark, theirs, str(tmp_path / "a")) == saved(spark, own, str(tmp_path / "b"))
    assert own.getNumTrees == trees and own.numClasses == theirs.numClasses and own.featureImportances == theirs.featureImportances
    for a, b in zip(forests.read_forest(spark, str(tmp_path / "a")), ours.nodes(), strict=True):
        assert np.array_equal(a, b, equal_nan=True)
    assert ours.transform(rows).where("prediction >= 0").count() == n


def test_values_below_zero_and_dense_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    values = np.round(rng.normal(size=(400, 12)), 1) * (rng.random((400, 12)) < 0.6)
    rows = [(float(v[0] + v[3] > 0.2), Vectors.dense(v) if i % 3 else Vectors.sparse(12, [(int(k), float(v[k])) for k in np.flatnonzero(v)])) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, ["label", "tfidf"]).repartition(3).cache()
    settings = RandomForestClassifier(labelCol="label", featuresCol="tfidf", seed=7, numTrees=5, maxDepth=5)
    assert saved(spark, settings.fit(df), str(tmp_path / "a")) == saved(spark, growth.SparseForest(settings).fit(df).model(spark), str(tmp_path / "b"))


def test_what_a_sparse_forest_does_not_grow(spark):
    for other in ({"impurity": "entropy"}, {"subsamplingRate": 0.5}, {"minInstancesPerNode": 3}):
        with pytest.raises(ValueError, match="usual"):
            growth.SparseForest(RandomForestClassifier(**other))
    rows = weighted(spark, 20, 2, 32)
    for label in (F.lit(0.5), F.lit(-1.0)):
        with pytest.raises(ValueError, match="labels"):
            growth.SparseForest(RandomForestClassifier(featuresCol="tfidf")).fit(rows.withColumn("label", label))
    with pytest.raises(ValueError, match="rows"):
        growth.SparseForest(RandomForestClassifier(featuresCol="tfidf")).fit(rows.where("label > 9"))


def test_draws_are_those_of_commons_math(spark):
    poisson = spark._jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    for seed, found in zip((43, 50, 1 << 40), growth.poisson_counts([43, 50, 1 << 40], [3000, 700, 1]), strict=True):
        poisson.reseedRandomGenerator(seed)
        assert found.tolist() == list(poisson.sample(len(found)))


def test_lookups_by_term_and_by_slot_count_the_same(spark, monkeypatch):
    rows = growth._split(weighted(spark, 900, 3, 256), "label", "tfidf")
    grown = []
    for share in (0.0, 1e9):
        monkeypatch.setattr(growth, "SPARSE", share)
        grown.append(growth.GrownForest(*growth.grow(rows, 6, 5, 1, 32, 256), RandomForestClassifier()).nodes())
    assert all(np.array_equal(a, b, equal_nan=True) for a, b in zip(*grown, strict=True)) and len(grown[0].left) > 50


def test_grid_search_grows_sparse_forests_and_one_for_limits_that_remove_the_same(spark, monkeypatch):
    for name, value in (("GRID_TREES", (2, 4)), ("GRID_DEPTH", (2, 3)), ("GRID_MAX_DF", (0.3, 0.75, 1.0)), ("TFIDF_FEATURES", 128), ("GRID_PARTITIONS", 2)):
        monkeypatch.setattr(text_ml, name, value)
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, i % 2, " ".join([*rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"], 2), "only" + "abcdefghi"[i % 9], ("good" if i % 2 else "poor") + "word" * (i % 4 > 0)]))
                                for i in range(90)], "doc_id long, label int, tweet string")
    own, fit = [], growth.SparseForest._fit
    monkeypatch.setattr(growth.SparseForest, "_fit", lambda self, rows: own.append(self.settings.getNumTrees()) or fit(self, rows))
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *a: pytest.fail("a dense forest"))
    results, _ = text_ml.grid_search(df)
    found = {}
    for r in results.collect():
        found.setdefault(r["max_df"], []).append((r["num_trees"], r["max_depth"], r["mean_accuracy"]))
    assert text_ml.terms_above(text_ml.clean_words(df), (0.3, 0.75, 1.0))[1:] == [[], []] and text_ml.frequent_terms(text_ml.clean_words(df), 0.3)
    assert len(own) == 3 * 2 + 1 and own[:6] == [4] * 6 and found[0.75] == found[1.0] and len(found[0.3]) == 4
