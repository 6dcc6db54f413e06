"""Scoring many settings of one fitted random forest at once.

A forest of fewer trees is the first trees of a larger one, and a tree of less
depth the same tree cut there, as every node keeps the class counts of its
rows.  So one grown forest answers for all smaller settings, and one pass over
the held-out rows scores them together: the nodes go to the tasks as arrays,
and a batch of rows descends all trees level by level in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that descend the trees together.
SCORED = 256


class Forest(NamedTuple):
    """Nodes of all trees, one tree after another: ``root`` of each tree, and of
    each node its children (-1 at a leaf), feature, threshold and class shares."""
    root: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    share: np.ndarray


def read_forest(spark: SparkSession, path: str) -> Forest:
    """The nodes of a saved ``RandomForestClassificationModel`` on continuous
    features.  A forest's size is set by its trees and depth, not by the rows it was fitted to."""
    rows = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    found = rows.select("treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                        node["impurityStats"].alias("counts"), node["split"]["featureIndex"].alias("feature"),
                        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold")).toPandas()
    found = found.sort_values(["treeID", "id"], ignore_index=True)
    tree, own = found["treeID"].to_numpy(), found["id"].to_numpy(np.int64)
    root = np.flatnonzero(np.diff(tree, prepend=-1))
    first = root[np.searchsorted(root, np.arange(len(found)), side="right") - 1]
    left, right = (found[side].to_numpy(np.int64) for side in ("left", "right"))
    if not (own == np.arange(len(found)) - first).all():
        raise ValueError("the nodes of a saved tree are numbered from 0 on")
    counts = np.array(found["counts"].tolist(), float)
    return Forest(root, np.where(left < 0, -1, first + left), np.where(right < 0, -1, first + right), found["feature"].to_numpy(np.int64),
                  found["threshold"].to_numpy(float), counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300))


def votes(forest: Forest, x: np.ndarray, depths: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """At each of these depths: the class shares that each tree gives each row, (rows, trees, classes)."""
    at = np.repeat(forest.root[None, :], len(x), axis=0)
    flat, base = x.ravel(), np.arange(len(x))[:, None] * x.shape[1]
    for level in range(max(depths) + 1):
        if level in depths:
            yield level, forest.share[at]
        left = forest.left.take(at)
        inner = left >= 0
        goes_left = flat.take(base + np.where(inner, forest.feature.take(at), 0)) <= forest.threshold.take(at)
        at = np.where(inner, np.where(goes_left, left, forest.right.take(at)), at)


def predictions(forest: Forest, x: np.ndarray, wanted: Sequence[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The class of each row for each (trees, depth): the largest sum of shares, the first of equal ones."""
    out = {}
    for level, shares in votes(forest, x, {depth for _, depth in wanted}):
        for trees, depth in wanted:
            if depth == level:
                out[trees, depth] = shares[:, :trees].sum(axis=1).argmax(axis=1)
    return out


def vector_parts(indices: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of vectors, sparse or dense (without indices): the number of terms of each, and all features and values."""
    if indices.null_count:
        found = [(np.arange(len(v)) if i is None else np.asarray(i, np.int64), np.asarray(v, float)) for i, v in zip(indices.to_pylist(), values.to_pylist(), strict=True)]
        return np.array([len(i) for i, _ in found], np.int64), np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found])
    lens = np.diff(indices.offsets.to_numpy()).astype(np.int64)
    return lens, indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False).astype(float)


def tfidf(vectors: pd.Series, idf: np.ndarray) -> np.ndarray:
    """Term counts (the parts of sparse or dense vectors) weighted and scaled to length 1."""
    x = np.zeros((len(vectors), len(idf)))
    for row, vector in zip(x, vectors, strict=True):
        values = np.asarray(vector["values"], float)
        row[slice(None) if vector["indices"] is None else np.asarray(vector["indices"], int)] = values
    x *= idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def accuracies(rows: DataFrame, label: str, columns: Sequence[str], models: Sequence[tuple[np.ndarray, Forest]],
               settings: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """The share of ``rows`` whose label each setting (model, trees, depth) predicts, in one job; NaN without rows.

    ``columns`` hold the models' term vectors; a model is its term weights and
    its forest.  Tasks return their counts only."""
    used = [np.unique(forest.feature[forest.left >= 0]) for _, forest in models]
    narrow = [(idf, own, forest._replace(feature=np.searchsorted(own, forest.feature))) for (idf, forest), own in zip(models, used, strict=True)]
    sent = rows.sparkSession.sparkContext.broadcast((narrow, list(settings)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, settings = sent.value
        hits, n = np.zeros(len(settings), np.int64), 0
        places = [np.full(len(idf), -1, np.int64) for idf, _, _ in models]
        for place, (_, own, _) in zip(places, models, strict=True):
            place[own] = np.arange(len(own))
        x = [np.zeros((SCORED, max(1, len(own)))) for _, own, _ in models]  # the features that a forest asks for
        for batch in batches:
            for at in range(0, len(batch), SCORED):
                part = batch.slice(at, SCORED)
                truth = part.column("label").to_numpy(zero_copy_only=False)
                n += len(part)
                for m, (idf, _, forest) in enumerate(models):
                    lens, feature, value = vector_parts(part.column(f"i{m}"), part.column(f"v{m}"))
                    row, value = np.repeat(np.arange(len(part)), lens), value * idf[feature]
                    value /= np.maximum(np.sqrt(np.bincount(row, weights=value * value, minlength=len(part))), 1e-300)[row]
                    kept = np.flatnonzero(places[m][feature] >= 0)
                    where = row[kept], places[m][feature[kept]]
                    x[m][where] = value[kept]
                    own = {(trees, depth): k for k, (i, trees, depth) in enumerate(settings) if i == m}
                    for setting, found in predictions(forest, x[m][:len(part)], list(own)).items():
                        hits[own[setting]] += int((found == truth).sum())
                    x[m][where] = 0.0
        yield pa.RecordBatch.from_pydict({"setting": pa.array(np.arange(len(settings)), pa.int32()), "hits": pa.array(hits, pa.int64()), "n": pa.array(np.full(len(settings), n), pa.int64())})

    vectors = [(i, F.unwrap_udt(c)) for i, c in enumerate(columns)]
    parts = rows.select(F.col(label).alias("label"), *[v["indices"].alias(f"i{i}") for i, v in vectors], *[v["values"].alias(f"v{i}") for i, v in vectors])
    total = parts.mapInArrow(count, "setting int, hits long, n long").groupBy("setting").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()
    sent.destroy()
    out = np.full(len(settings), np.nan)
    for r in total:
        if r["n"]:
            out[r["setting"]] = r["hits"] / r["n"]
    return out
