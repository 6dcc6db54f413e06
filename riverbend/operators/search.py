"""Search-style queries over a DataFrame: boolean query of range predicates
(match-all when empty) and a terms aggregation (top values by count).

A search index answers these from its inverted index; on Spark the range
predicate is a filter pushed to the parquet scan and the terms aggregation
is a partial/final aggregate followed by a top-k (``TakeOrderedAndProject``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ts_literal(df: DataFrame, field: str, millis: int) -> Column:
    text = (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=millis)) \
        .strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[field].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.timestamp_millis(F.lit(millis))


def epoch_millis_range(df: DataFrame, field: str, gte: int | None = None,
                       lte: int | None = None) -> Column:
    """``gte <= field <= lte`` with bounds in epoch milliseconds (both inclusive,
    compared at millisecond precision like a date field of an index).

    On a timestamp column the bounds become timestamp literals, so the
    predicate reaches the parquet scan as a pushed filter.
    """
    dtype = df.schema[field].dataType
    cond = F.lit(True)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if gte is not None:
            cond = cond & (F.col(field) >= _ts_literal(df, field, gte))
        if lte is not None:
            cond = cond & (F.col(field) < _ts_literal(df, field, lte + 1))
    else:
        if gte is not None:
            cond = cond & (F.col(field) >= F.lit(gte))
        if lte is not None:
            cond = cond & (F.col(field) <= F.lit(lte))
    return cond


def bool_query(must: Sequence[Column] = (), must_not: Sequence[Column] = ()) -> Column:
    """Conjunction of ``must`` and negated ``must_not``; empty lists match all."""
    cond = F.lit(True)
    for c in must:
        cond = cond & c
    for c in must_not:
        cond = cond & ~F.coalesce(c, F.lit(False))
    return cond


def terms(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """Top ``size`` values of ``field`` by count (ties: value ascending):
    ``(key, doc_count)``.  The top-k cut is the feature of this aggregation."""
    counts = df.groupBy(F.col(field).alias("key")).agg(F.count(F.lit(1)).alias("doc_count"))
    return counts.orderBy(F.col("doc_count").desc(), F.col("key").asc()).limit(size)


def search(df: DataFrame, must: Sequence[Column] = (), must_not: Sequence[Column] = (),
           terms_field: str | None = None, size: int = 10) -> DataFrame:
    hits = df.filter(bool_query(must, must_not))
    return terms(hits, terms_field, size) if terms_field else hits
