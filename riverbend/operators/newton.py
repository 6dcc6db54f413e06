"""Logistic regression by Newton's method (iteratively reweighted least
squares), one Spark aggregate a step.

For a few numeric features the whole step is a handful of sums: the gradient,
and the upper half of the Hessian.  Each pass computes them with map-side
partial sums, so what travels does not grow with the rows, and the driver
solves a system as wide as the features.  The objective is that of
``pyspark.ml``: mean log loss plus half the ridge times the squared norm of
the coefficients of standardised features, intercept not included.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.operators.joins import one_row

MAX_ITER, TOLERANCE = 50, 1e-10


class Logistic(NamedTuple):
    """A fitted model; ``coefficients`` and ``intercept`` are those of the features as given."""
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int

    def probability(self) -> Column:
        """P(label = 1); null where a feature is."""
        margin = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients, strict=True):
            margin = margin + F.col(name) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _known(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    rows = df.select(F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f) for f in features])
    return rows.where(F.col("y").isin(0.0, 1.0)).na.drop()


def _scales(rows: DataFrame, features: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and standard deviations; a constant feature has the deviation 1 and so the coefficient 0."""
    st = one_row(rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{i}") for i, f in enumerate(features)],
                          *[F.stddev_samp(f).alias(f"s_{i}") for i, f in enumerate(features)]))
    if not st["n"]:
        raise ValueError("no row has a label of 0 or 1 and all features")
    deviations = np.array([st[f"s_{i}"] or 0.0 for i in range(len(features))])
    return st["n"], np.array([st[f"m_{i}"] for i in range(len(features))]), np.where(deviations > 1e-12, deviations, 1.0)


def _sums(rows: DataFrame, x: list[Column], w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss, gradient and Hessian of the summed log likelihood at ``w``, from one aggregate."""
    margin = sum((c * F.lit(float(b)) for c, b in zip(x[1:], w[1:], strict=True)), F.lit(float(w[0])))
    rows = rows.select("y", margin.alias("z"), *[c.alias(f"x_{i}") for i, c in enumerate(x)])
    rows = rows.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
    # log(1 + exp(z)) without overflow
    loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
    d = len(x)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    curve = F.col("p") * (F.lit(1.0) - F.col("p"))
    st = one_row(rows.agg(F.sum(loss).alias("loss"), *[F.sum((F.col("y") - F.col("p")) * F.col(f"x_{i}")).alias(f"g_{i}") for i in range(d)],
                          *[F.sum(curve * F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"h_{i}_{j}") for i, j in pairs]))
    hessian = np.zeros((d, d))
    for i, j in pairs:
        hessian[i, j] = hessian[j, i] = st[f"h_{i}_{j}"]
    return st["loss"], np.array([st[f"g_{i}"] for i in range(d)]), hessian


def fit(df: DataFrame, features: Sequence[str], label: str = "label", ridge: float = 0.001, max_iter: int = MAX_ITER,
        tolerance: float = TOLERANCE) -> Logistic:
    """Fit to the rows with a label of 0 or 1 and no null feature.

    Every step reads ``df`` again: pass a saved or cached table of numbers.  A
    step that would raise the objective is halved.  With ``ridge`` 0 and
    classes that a plane separates there is no finite optimum; the fit then ends after ``max_iter`` steps."""
    features = list(features)
    rows = _known(df, features, label)
    n, means, deviations = _scales(rows, features)
    x = [F.lit(1.0)] + [(F.col(f) - F.lit(float(m))) / F.lit(float(s)) for f, m, s in zip(features, means, deviations, strict=True)]
    weight = np.full(len(x), ridge * n)
    weight[0] = 0.0
    w = np.zeros(len(x))
    loss, gradient, hessian = _sums(rows, x, w)
    value = loss
    for steps in range(1, max_iter + 1):
        step = np.linalg.lstsq(hessian + np.diag(weight), gradient - weight * w, rcond=None)[0]
        while True:
            loss, gradient, hessian = _sums(rows, x, w + step)
            new = loss + 0.5 * float(weight @ (w + step) ** 2)
            if new <= value + 1e-9 * max(1.0, abs(value)) or np.abs(step).max() < tolerance:
                break
            step /= 2
        w, value = w + step, new
        if np.abs(step).max() < tolerance:
            break
    coefficients = w[1:] / deviations
    return Logistic(tuple(features), tuple(coefficients.tolist()), float(w[0] - coefficients @ means), steps)
