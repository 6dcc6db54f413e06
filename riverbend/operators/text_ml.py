"""Text classification (domain F): pipelines, scoring, bands, block inference,
grid search and sampling, on ``pyspark.ml``.

* ``lr_pipeline``: Tokenizer -> HashingTF(1000) -> LogisticRegression(10 iters,
  reg 0.001).
* ``rf_pipeline``: Tokenizer -> HashingTF(1000) -> StringIndexer(label) ->
  VectorIndexer(10 categories) -> RandomForest(10 trees) -> IndexToString.
  The reference indexed the text column instead of the label (every tweet a
  class); here the label is indexed, and unseen labels are kept.
* ``tfidf_rf_pipeline`` + ``grid_search``: letters-only cleaning, lower-cased
  tokens longer than 3, terms in more than a share of the documents removed
  (an aggregate over all of them), HashingTF -> IDF -> L2 norm ->
  RandomForest, 3-fold cross validation over the reference's 3 x 3 x 2 grid
  (nine forests at most are grown, in which all 18 settings are scored).
  Terms are hashed, so none is left out and no vocabulary is gathered.  (The
  stemmer of the reference is not built.)
* ``block_scores``: a model trained outside the pipeline (a small numpy
  linear discriminant, fitted from one grouped aggregate) scored with
  ``mapInPandas`` over Arrow batches of three numbers a row, computed JVM-side.

The hashing stages need no fit, so training texts are hashed before they are
joined to their labels: vectors are shuffled, not texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (IDF, HashingTF, IndexToString, Normalizer, StringIndexer,
                                StringIndexerModel, Tokenizer, VectorIndexer)
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.functions.scores import band, positive_index, positive_probability
from riverbend.functions.text import clean_long_tokens, letter_count
from riverbend.operators import forests, growth, sampling
from riverbend.session import release, save

# Fixed values of the reference pipelines.
NUM_FEATURES = 1000
LR_MAX_ITER = 10
LR_REG_PARAM = 0.001
RF_TREES = 10
MAX_CATEGORIES = 10
GRID_MAX_DF = (0.5, 0.75, 1.0)
GRID_TREES = (40, 60, 100)
GRID_DEPTH = (5, 8)
CV_FOLDS = 3
# partitions that the rows of a fit are dealt to at least, rows of one at most (on average), and the counts, as Spark's
# forest would hold them, of the nodes that are split in one pass.  A forest's draws depend on all three.
GRID_PARTITIONS = 8
GRID_ROWS = 8000
GRID_MEMORY_MB = 1024
# width of the hashed tf-idf vectors: terms that share a place are added up, none is dropped
TFIDF_FEATURES = 1 << 14
# the RF is trained on the first part of a 0.1 / 0.9 split, itself split 0.7 / 0.3
RF_SUBSET = (0.1, 0.9)
RF_TRAIN_TEST = (0.7, 0.3)


def lr_pipeline(text_col: str = "tweet", label_col: str = "label") -> Pipeline:
    tok = Tokenizer(inputCol=text_col, outputCol="words")
    tf = HashingTF(numFeatures=NUM_FEATURES, inputCol="words", outputCol="features")
    lr = LogisticRegression(maxIter=LR_MAX_ITER, regParam=LR_REG_PARAM, labelCol=label_col)
    return Pipeline(stages=[tok, tf, lr])


def lower_tokens(df: DataFrame, text_col: str = "tweet", out: str = "words") -> DataFrame:
    """The tokens that both pipelines start from: lower case, cut at every white-space character."""
    return Tokenizer(inputCol=text_col, outputCol=out).transform(df)


def rf_pipeline(text_col: str = "tweet", label_col: str = "label", seed: int = 42) -> Pipeline:
    tok = Tokenizer(inputCol=text_col, outputCol="words")
    tf = HashingTF(numFeatures=NUM_FEATURES, inputCol="words", outputCol="features")
    lab = StringIndexer(inputCol=label_col, outputCol="indexedLabel", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    vec = VectorIndexer(inputCol="features", outputCol="indexedFeatures",
                        maxCategories=MAX_CATEGORIES, handleInvalid="keep")
    rf = RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures",
                                numTrees=RF_TREES, seed=seed)
    return Pipeline(stages=[tok, tf, lab, vec, rf])


def fit_cached(estimator, train: DataFrame):
    """Fit with the training rows kept in executor memory/disk for the
    duration of the fit: every pipeline stage and optimizer pass reads them
    again (the reference persists its reused join the same way).  A lost
    executor's cached blocks are recomputed from the lineage."""
    train = train.persist()
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def fit_hashed(pipeline: Pipeline, docs: DataFrame, labels: DataFrame, key: str = "doc_id",
               pick=lambda rows: rows) -> PipelineModel:
    """Fit a pipeline that starts with a tokenizer and a term hash on ``docs``
    joined to ``labels`` on ``key``.  Those two stages run before the join;
    ``pick`` chooses the training rows after it."""
    first, rest = pipeline.getStages()[:2], pipeline.getStages()[2:]
    hashed = PipelineModel(stages=first).transform(docs).drop(first[0].getInputCol(), first[0].getOutputCol())
    model = fit_cached(Pipeline(stages=rest), pick(hashed.join(labels, key)))
    return PipelineModel(stages=[*first, *model.stages])


def rf_training_rows(labelled: DataFrame, seed: int = 42, subset=RF_SUBSET, train_test=RF_TRAIN_TEST, key: str = "doc_id") -> DataFrame:
    """The RF's training rows: the first part of the ``subset`` split (10 % in
    the reference), then the first part of the ``train_test`` split (70 %).
    Pass ``subset=(1.0,)`` to learn from all.  Rows are dealt by their key's hash."""
    rows = sampling.split(labelled, key, subset, seed, "subset")[0]
    return sampling.split(rows, key, train_test, seed, "train")[0]


def with_label_names(model: PipelineModel) -> PipelineModel:
    """Append IndexToString with the fitted label names (``predictedLabel``)."""
    labels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels
    conv = IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=list(labels))
    return PipelineModel(stages=list(model.stages) + [conv])


def score(model: PipelineModel, df: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Transform and keep ``keep`` + the positive-class probability and band."""
    out = model.transform(df)
    p = positive_probability("probability", positive_index(model))
    return out.select(*keep, p.alias("clean_probability"),
                      band(p).alias("band"), F.col("prediction"))


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    """Persist with overwrite and load back (the deployment round trip)."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


# ------------------------------------------------------------------ tf-idf + grid

def clean_words(df: DataFrame, text_col: str = "tweet", out: str = "tokens") -> DataFrame:
    """Letters only, tokens longer than 3 characters, lower case (no stemming)."""
    return df.withColumn(out, F.transform(clean_long_tokens(text_col, 3), F.lower))


def frequent_terms(df: DataFrame, max_share: float, col: str = "tokens") -> list[str]:
    """Terms held by more than ``max_share`` of the rows.  There are at most
    (mean number of terms in a row) / ``max_share`` of them."""
    return terms_above(df, (max_share,), col)[0]


def terms_above(df: DataFrame, max_shares: Sequence[float], col: str = "tokens") -> list[list[str]]:
    """``frequent_terms`` for several limits, from one aggregate."""
    limits = [share for share in max_shares if share < 1.0]
    if not limits:
        return [[] for _ in max_shares]
    n = df.count()
    counts = df.select(F.explode(F.array_distinct(col)).alias("term")).groupBy("term").count()
    found = counts.where(F.col("count") > min(limits) * n).collect()
    return [sorted(r["term"] for r in found if share < 1.0 and r["count"] > share * n) for share in max_shares]


def without_terms(df: DataFrame, terms: list[str], col: str = "tokens") -> DataFrame:
    gone = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    return df.withColumn(col, F.filter(col, lambda t: ~F.array_contains(gone, t))) if terms else df


def tfidf_rf_pipeline(label_col: str = "label", seed: int = 42, **draws):
    """The pipeline and the settings of its forest; ``draws`` are those that ``growth.SparseForest`` may share."""
    tf = HashingTF(numFeatures=TFIDF_FEATURES, inputCol="tokens", outputCol="tf")
    idf = IDF(inputCol="tf", outputCol="weighted")
    norm = Normalizer(p=2.0, inputCol="weighted", outputCol="tfidf")
    rf = RandomForestClassifier(labelCol=label_col, featuresCol="tfidf", seed=seed, maxMemoryInMB=GRID_MEMORY_MB)
    return Pipeline(stages=[tf, idf, norm, growth.SparseForest(rf, **draws)]), rf


def _dealt(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows in an order and partitioning that follow from their keys: a forest draws its samples in that order."""
    return rows.repartition(parts, key).sortWithinPartitions(key)


def grid_search(train: DataFrame, label_col: str = "label", parallelism: int = 4, seed: int = 42, key: str = "doc_id",
                folds: int = CV_FOLDS) -> tuple[DataFrame, PipelineModel]:
    """3-fold cross validation over maxDF x trees x depth (18 settings).

    Folds are dealt by the key's hash and term vectors written once.  For each
    fold and maxDF the largest forest is grown, once; a setting with fewer
    trees or less depth is its first trees, cut at that depth, which are drawn
    and grown in the same way.  Limits that remove the same terms have the same
    vectors and share a forest.  All settings are scored in one pass over the held-out rows of a fold.

    Returns ``(results, best_model)``; results hold one row per setting with
    the mean accuracy over the folds and a best flag (the first of equal
    ones); the model is fitted with it to all rows.  The same rows give the same result in any partitioning.
    Rows without a label of 0, 1, ... are left out.
    """
    spark = train.sparkSession
    words, words_path = save(clean_words(train.where(F.col(label_col) >= 0)).select(key, F.col(label_col).cast("double").alias("label"), "tokens"), "grid-words")
    parts = max(GRID_PARTITIONS, -(-words.count() // GRID_ROWS))  # follows from the rows alone
    vectors = words.withColumn("fold", sampling.split_part(key, [1.0] * folds, seed, "fold"))
    common = terms_above(words, GRID_MAX_DF)
    removed = [terms for i, terms in enumerate(common) if terms not in common[:i]]
    for i, terms in enumerate(removed):
        kept = without_terms(vectors.withColumn("kept", F.col("tokens")), terms, "kept")
        vectors = HashingTF(numFeatures=TFIDF_FEATURES, inputCol="kept", outputCol=f"tf_{i}").transform(kept).drop("kept")
    vectors, vectors_path = save(_dealt(vectors.drop("tokens"), key, parts).withColumn("part", F.spark_partition_id()), "grid-vectors")
    sizes = {r["part"]: r["count"] for r in vectors.groupBy("part").count().collect()}
    subsets = growth.Subsets()

    def rows_of(chosen: DataFrame, i: int) -> DataFrame:
        return _dealt(chosen.select(key, "label", F.col(f"tf_{i}").alias("tf")), key, parts)

    def grow(job: tuple[int, int]):
        fold, i = job
        pipe, rf = tfidf_rf_pipeline(seed=seed, counts=counts.get, subsets=subsets)
        rf.setNumTrees(max(GRID_TREES)).setMaxDepth(max(GRID_DEPTH))
        fitted = fit_cached(Pipeline(stages=pipe.getStages()[1:]), rows_of(vectors.where(F.col("fold") != fold), i))
        return job, (fitted.stages[0].idf.toArray(), fitted.stages[-1].nodes())

    jobs = [(fold, i) for fold in range(folds) for i in range(len(removed))]
    with ThreadPool(parallelism) as pool:
        counts = pool.apply_async(inheritable_thread_target(spark)(growth.bootstrap_counts), (spark, sizes, max(GRID_TREES), seed))
        grown = dict(pool.map(inheritable_thread_target(spark)(grow), jobs, chunksize=1))

    settings = [(i, trees, depth) for i in range(len(GRID_MAX_DF)) for trees in GRID_TREES for depth in GRID_DEPTH]
    of = [(removed.index(common[i]), trees, depth) for i, trees, depth in settings]
    scored = list(dict.fromkeys(of))
    hits = np.zeros((folds, len(settings)))
    for fold in range(folds):
        rows = vectors.where(F.col("fold") == fold)
        models = [grown[fold, i] for i in range(len(removed))]
        found = forests.accuracies(rows, "label", [f"tf_{i}" for i in range(len(models))], models, scored)
        hits[fold] = [found[scored.index(setting)] for setting in of]
    mean = np.nanmean(hits, axis=0)
    first = int(np.argmax(mean))
    results = spark.createDataFrame([(GRID_MAX_DF[i], trees, depth, float(m), k == first) for k, ((i, trees, depth), m) in enumerate(zip(settings, mean, strict=True))],
                                    "max_df double, num_trees int, max_depth int, mean_accuracy double, best boolean")
    i, trees, depth = settings[first]
    pipe, rf = tfidf_rf_pipeline(seed=seed, counts=counts.get, subsets=subsets)
    rf.setNumTrees(trees).setMaxDepth(depth)
    tf, *rest = pipe.getStages()
    fitted = fit_cached(Pipeline(stages=rest), rows_of(vectors, removed.index(common[i])))
    best = PipelineModel(stages=[tf, *fitted.stages[:-1], fitted.stages[-1].model(spark)])
    release(spark, words_path, vectors_path, counts.get().path)
    return results, best


# ------------------------------------------------------------------ block inference

NUMERIC_FEATURES = ("n_chars", "letter_share", "mean_word_len")


def numeric_features(df: DataFrame, text_col: str = "tweet") -> DataFrame:
    """Spark-side features used to train the foreign model."""
    n = F.length(text_col)
    letters = letter_count(text_col)
    words = F.size(F.split(F.trim(F.col(text_col)), "\\s+"))
    return df.select("*",
                     F.log1p(n.cast("double")).alias("n_chars"),
                     F.when(n > 0, letters / n).otherwise(0.0).alias("letter_share"),
                     F.when(words > 0, n / words).otherwise(0.0).alias("mean_word_len"))


def fit_foreign_model(train: DataFrame, label_col: str = "label") -> dict[str, np.ndarray]:
    """A linear discriminant with per-feature variances on ``NUMERIC_FEATURES``.

    One grouped aggregate (count, mean, variance per class and feature)
    gives the class-conditional normals; with a shared variance per feature
    the log-odds are linear: ``w = (mu1 - mu0) / var``, ``b = log(n1 / n0) -
    sum((mu1^2 - mu0^2) / (2 var))``.  The result is 3 weights and an
    intercept (a fixed small size), scored outside Spark ML by numpy.
    """
    rows = train if set(NUMERIC_FEATURES) <= set(train.columns) else numeric_features(train)
    feats = rows.select(F.col(label_col).cast("int").alias("y"), *NUMERIC_FEATURES)
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in NUMERIC_FEATURES:
        aggs += [F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}")]
    known = feats.where(F.col("y").isin(0, 1))
    by_class = {r["y"]: r for r in known.groupBy("y").agg(*aggs).collect()}   # one row per class
    c0, c1 = by_class.get(0), by_class.get(1)
    if c0 is None or c1 is None:
        only = 1.0 if c1 is not None else 0.0
        return {"w": np.zeros(len(NUMERIC_FEATURES)), "b": np.array([20.0 if only else -20.0])}
    n0, n1 = float(c0["n"]), float(c1["n"])
    mu0 = np.array([c0[f"m_{f}"] for f in NUMERIC_FEATURES], dtype=float)
    mu1 = np.array([c1[f"m_{f}"] for f in NUMERIC_FEATURES], dtype=float)
    var = (n0 * np.array([c0[f"v_{f}"] for f in NUMERIC_FEATURES], dtype=float)
           + n1 * np.array([c1[f"v_{f}"] for f in NUMERIC_FEATURES], dtype=float)) / (n0 + n1)
    var = np.where(var > 1e-12, var, 1e-12)
    w = (mu1 - mu0) / var
    b = np.log(n1 / n0) - float(np.sum((mu1 ** 2 - mu0 ** 2) / (2 * var)))
    return {"w": w, "b": np.array([b])}


WEIGHTS_DDL = "w array<double>, b double"


def save_weights(spark: SparkSession, weights: dict[str, np.ndarray], path: str) -> None:
    row = [([float(x) for x in weights["w"]], float(weights["b"][0]))]
    spark.createDataFrame(row, WEIGHTS_DDL).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    row = spark.read.schema(WEIGHTS_DDL).parquet(path).first()
    return {"w": np.array(row["w"]), "b": np.array([row["b"]])}


# Fixed value of the reference's inference: rows of a block.
BLOCK_ROWS = 10_000


def in_blocks(batches, rows: int):
    """A task's batches as blocks of ``rows`` rows, the last of what is left, whatever the session's batch size."""
    held, n = [], 0
    for pdf in batches:
        while n + len(pdf) >= rows:
            yield pd.concat([*held, pdf.iloc[:rows - n]], ignore_index=True)
            pdf, held, n = pdf.iloc[rows - n:], [], 0
        if len(pdf):
            held.append(pdf)
            n += len(pdf)
    if held:
        yield pd.concat(held, ignore_index=True)


def block_scores(df: DataFrame, weights: dict[str, np.ndarray], text_col: str = "tweet",
                 keep=("doc_id",)) -> DataFrame:
    """Score every row with the foreign model in Arrow batches.

    The features are computed JVM-side, so three numbers a row go to Python;
    each task scores whole batches with numpy (no per-row Python call).
    """
    keep = list(keep)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("proba", T.DoubleType())])
    w, b, names = weights["w"], float(weights["b"][0]), list(NUMERIC_FEATURES)

    def classify(batches):
        for pdf in in_blocks(batches, BLOCK_ROWS):
            out = pdf[keep].copy()
            out["proba"] = 1.0 / (1.0 + np.exp(-(pdf[names].to_numpy() @ w + b)))
            yield out

    return numeric_features(df, text_col).select(*keep, *names).mapInPandas(classify, schema)


# ------------------------------------------------------------------ sampling

# Fixed values of the reference's sampling: 0.5 % without replacement for the
# grid-search sample, 16 rows (0.001 % of its 1.6 million) with replacement
# for the stream feeder, seed 42.
SAMPLE_FRACTION = 0.005
FEED_ROWS = 16
SEED = 42


def samples(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SEED,
            split=(0.7, 0.3), feed_rows: int = FEED_ROWS, key: str = "doc_id") -> DataFrame:
    """``doc_id, part``: a seeded sample without replacement (``sample``), one of
    about ``feed_rows`` rows with replacement (``feed``, a row may repeat) and
    a seeded random split (``train`` / ``test``).  All are drawn from the keys'
    hashes, so they are the same however the rows are partitioned."""
    train, test = sampling.split(df, key, split, seed)
    parts = {"sample": sampling.sample(df, key, fraction, seed),
             "feed": sampling.sample_with_replacement(df, key, feed_rows / max(1, df.count()), seed),
             "train": train, "test": test}
    named = [rows.select(key, F.lit(name).alias("part")) for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, named)
