"""Samples and splits drawn by a hash of each row's key.

A row's fate depends on its key, the seed and the purpose alone, so a sample is
the same however the rows are partitioned, ordered or read, and any engine
with md5 draws it too.  Nothing is shuffled or counted.  Rows of one key
share their fate; a null key counts as the empty text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that make the draw: 52 bits, which a double holds exactly.
DIGITS = 13


def uniform(key: str, seed: int, purpose: str) -> Column:
    """A draw in [0, 1) for the row's key: the first digits of
    ``md5('<seed>:<purpose>:<key>')`` as a fraction.  Draws for different purposes are independent."""
    text = F.concat(F.lit(f"{seed}:{purpose}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def sample(df: DataFrame, key: str, fraction: float, seed: int, purpose: str = "sample") -> DataFrame:
    """A sample without replacement: each key with probability ``fraction``."""
    return df.where(uniform(key, seed, purpose) < fraction)


def poisson_steps(rate: float) -> list[float]:
    """P(copies <= k) for k = 0, 1, ... up to where a draw of 52 bits tells no more."""
    if not 0 <= rate <= 500:
        raise ValueError("a rate of 0 to 500 copies a row")
    term = total = math.exp(-rate)
    steps = [total]
    while total < 1 - 2.0 ** -53 and (term > 2.0 ** -60 or len(steps) < rate):
        term *= rate / len(steps)
        total += term
        steps.append(total)
    return steps


def sample_with_replacement(df: DataFrame, key: str, rate: float, seed: int, purpose: str = "feed") -> DataFrame:
    """A sample with replacement: a row comes as often as a Poisson count of
    mean ``rate``, drawn from its key, says."""
    steps = F.array(*[F.lit(p) for p in poisson_steps(rate)])
    copies = F.size(F.filter(steps, lambda p: p <= uniform(key, seed, purpose)))
    return df.withColumn("_copies", copies).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")


def split_part(key: str, weights: Sequence[float], seed: int, purpose: str = "split") -> Column:
    """The number (from 0) of the part that the row's key falls in; the parts have the weights' shares."""
    if not weights or min(weights) < 0 or not sum(weights):
        raise ValueError("weights are positive")
    u, at, out = uniform(key, seed, purpose), 0.0, F.lit(len(weights) - 1)
    bounds = []
    for w in weights[:-1]:
        at += w / sum(weights)
        bounds.append(at)
    for i in reversed(range(len(bounds))):
        out = F.when(u < bounds[i], F.lit(i)).otherwise(out)
    return out


def split(df: DataFrame, key: str, weights: Sequence[float], seed: int, purpose: str = "split") -> list[DataFrame]:
    """The rows dealt to parts with the weights' shares; every row is in one part."""
    part = split_part(key, weights, seed, purpose)
    return [df.where(part == i) for i in range(len(weights))]
