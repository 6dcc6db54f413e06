import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbend.operators import newton, sampling, text_ml


def draw(key, seed, purpose):
    return int(hashlib.md5(f"{seed}:{purpose}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 16 ** 13


def keyed(spark, n):
    return spark.range(n).select(F.col("id").alias("k"))


def test_draws_are_those_of_the_hash(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k long").select("k", sampling.uniform("k", 7, "x").alias("u")).collect()
    assert {r.k: r.u for r in rows} == {k: draw(k, 7, "x") for k in (1, 2, None)}


def test_samples_do_not_depend_on_partitions_or_order(spark):
    df = keyed(spark, 5000)
    again = df.repartition(13).orderBy(F.desc("k")).coalesce(3)
    for rows in (lambda d: sampling.sample(d, "k", 0.1, 5), lambda d: sampling.sample_with_replacement(d, "k", 0.7, 5), lambda d: sampling.split(d, "k", (7, 3), 5)[1]):
        assert sorted(r.k for r in rows(df).collect()) == sorted(r.k for r in rows(again).collect())


def test_sample_sizes_and_split_are_whole(spark):
    df = keyed(spark, 20_000)
    assert abs(sampling.sample(df, "k", 0.25, 1).count() - 5000) < 250
    assert sampling.sample(df, "k", 0.0, 1).count() == 0 and sampling.sample(df, "k", 1.0, 1).count() == 20_000
    parts = sampling.split(df, "k", (0.5, 0.0, 0.25, 0.25), 3)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 20_000 and sizes[1] == 0 and abs(sizes[0] - 10_000) < 300 and abs(sizes[3] - 5000) < 250
    assert [r.k for r in sampling.split(df, "k", (1.0,), 3)[0].limit(0).collect()] == []
    both = sampling.sample(df, "k", 0.5, 1).intersect(sampling.sample(df, "k", 0.5, 2)).count()
    assert abs(both - 5000) < 300  # seeds are independent


@pytest.mark.parametrize("rate", [0.0, 0.001, 0.3, 1.0, 4.0, 60.0])
def test_copies_are_poisson(spark, rate):
    n = 4000
    rows = sampling.sample_with_replacement(keyed(spark, n), "k", rate, 9).groupBy("k").count().collect()
    copies = [r["count"] for r in rows] + [0] * (n - len(rows))
    assert abs(np.mean(copies) - rate) < 5 * math.sqrt(rate / n) + 1e-9
    if rate >= 0.3:
        assert abs(np.var(copies) / rate - 1) < 0.15
    assert set(rows[0].asDict()) == {"k", "count"} if rows else rate == 0 or rate < 0.01


def test_rates_and_weights_are_checked():
    for bad in (-1, 501):
        with pytest.raises(ValueError):
            sampling.poisson_steps(bad)
    for bad in ([], [-1, 2], [0, 0]):
        with pytest.raises(ValueError):
            sampling.split_part("k", bad, 1)


def points(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 40, 0.01] + [5, -300, 2]
    margin = 0.8 * (x[:, 0] - 5) - 0.02 * (x[:, 1] + 300) + 30 * (x[:, 2] - 2) + 0.4
    y = (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(int)
    return spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, label int")


def test_newton_is_the_optimum_that_ml_finds(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = points(spark).cache()
    own = newton.fit(df, ["a", "b", "c"], ridge=0.01)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    other = LogisticRegression(regParam=0.01, maxIter=300, tol=1e-12).fit(vectors)
    assert np.allclose(own.coefficients, other.coefficients.toArray(), rtol=1e-4) and math.isclose(own.intercept, other.intercept, rel_tol=1e-4)
    assert own.steps < 12
    mine = [r[0] for r in df.select(own.probability()).collect()]
    theirs = [r.probability[1] for r in other.transform(vectors).select("probability").collect()]
    assert np.allclose(mine, theirs, atol=1e-4)


def test_newton_edges(spark):
    df = points(spark, 200)
    extra = spark.createDataFrame([(1.0, None, 1.0, 1), (None, 1.0, 1.0, 0), (1.0, 1.0, 1.0, None), (1.0, 1.0, 1.0, 2), (float("nan"), 1.0, 1.0, 1)], df.schema)
    assert newton.fit(df.union(extra), ["a", "b", "c"]).coefficients == pytest.approx(newton.fit(df, ["a", "b", "c"]).coefficients, rel=1e-9)
    one = newton.fit(df.where("label = 1"), ["a"], ridge=0.1)
    assert one.probability() is not None and one.intercept > 3  # one class: its probability goes to 1
    constant = newton.fit(df.withColumn("d", F.lit(3.0)), ["a", "d"])
    assert constant.coefficients[1] == 0.0
    split = spark.createDataFrame([(float(i), int(i > 0)) for i in range(-20, 21)], "a double, label int")
    assert newton.fit(split, ["a"], ridge=0.001).coefficients[0] > 0.3  # a plane separates the classes
    with pytest.raises(ValueError):
        newton.fit(df.limit(0), ["a"])
    assert df.limit(1).select(one.probability().alias("p")).union(spark.createDataFrame([(None,)], "p double")).count() == 2


def test_a_step_is_one_aggregate(spark):
    from test_plans import logged_plans
    df = points(spark).cache()
    df.count()
    fitted = []
    plans = logged_plans(spark, lambda: fitted.append(newton.fit(df, ["a", "b", "c"])))
    final = [p for p in plans if "isFinalPlan=true" in p and "partial_sum" in p]
    assert len(final) == fitted[0].steps + 1 and not any("Join" in p for p in plans)


def test_training_rows_do_not_depend_on_partitions(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("label"))
    one = sorted(r.doc_id for r in text_ml.rf_training_rows(rows).collect())
    assert one == sorted(r.doc_id for r in text_ml.rf_training_rows(rows.repartition(9)).collect()) and 150 < len(one) < 270
    assert text_ml.rf_training_rows(rows, subset=(1.0,), train_test=(1.0,)).count() == 3000
