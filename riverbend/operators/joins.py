"""Join helpers: anti joins, latest row per key.

Whether a side is broadcast is left to the planner, which decides by bytes
(``spark.sql.autoBroadcastJoinThreshold``), again at run time under AQE once
real sizes are known; larger sides are shuffled and skewed keys split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def anti_join(src: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``src`` with no row in ``target`` on ``keys`` (LEFT JOIN .. IS NULL).

    Null keys never match, as in the SQL form.
    """
    cond = [src[k] == target[k] for k in keys]
    return src.join(target.select(*keys), cond, "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   descending: bool = True) -> DataFrame:
    """One row per key: the one with the largest (or smallest) ``order`` tuple.

    Built as ``max(struct(order..., rest...))`` per key: an aggregate with a
    map-side partial step, so a key holding a third of the table is reduced
    inside every input task before the shuffle.  (Spark runs a maximum of
    structs as a sort aggregate: each task sorts its own rows by key.)  ``order`` should end in a unique column to make ties
    deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("_row")
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_row"))
    return out.select(*keys, *[F.col("_row." + c).alias(c) for c in list(order) + rest]) \
              .select(*df.columns)


def one_row(df: DataFrame) -> dict | None:
    """The single row of a DataFrame that is at most one row by construction
    (a global aggregate, the latest row of one key) as a dict, or None.

    Reading such a row as scalars and using them as literals replaces a join
    on constants: no cross join, no broadcast, one tiny job."""
    rows = df.take(2)
    if len(rows) > 1:
        raise ValueError("expected at most one row")
    return rows[0].asDict() if rows else None


# ---------------------------------------------------------------- small and filtering sides

#: A dimension of up to this size is copied to every executor.
REPLICATED_BYTES = 64 << 20
#: Bits of a key filter for each key, and the most that a filter may have (8 MB).
BITS_PER_KEY, MAX_BITS = 12, 1 << 26
HASHES = 5


def measured_bytes(df: DataFrame) -> int:
    """The size of all rows as text, an upper measure of what a copy takes; one aggregate."""
    return one_row(df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})) + 16), F.lit(0)).alias("n")))["n"]


def replicated(dim: DataFrame, max_bytes: int = REPLICATED_BYTES) -> DataFrame:
    """``dim`` marked to be copied to every executor (an unsegmented table),
    if its rows, measured, are at most ``max_bytes``; else as it is, and joins shuffle it."""
    return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim


def _places(key: Column, bits: int) -> list[Column]:
    """The bits of a key: ``HASHES`` steps through the filter, start and step from two hashes."""
    size = F.lit(bits).cast("long")
    first, step = (F.pmod(F.xxhash64(key, F.lit(seed)), size) for seed in (1, 2))
    return [F.pmod(first + F.lit(i) * step, size) for i in range(HASHES)]


def key_filter(dim: DataFrame, dim_key: str, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS):
    """A Bloom filter of the keys of ``dim``: a function from a key column to
    the condition that ``dim`` may have that key.  It is sized by the number
    of keys, counted first; None where that needs more than ``max_bits``.

    The filter is one row, an array of its 64-bit words, computed by a scalar
    subquery of the query that uses it: masks are combined in the tasks, a word's masks in one place."""
    keys = dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("key")).distinct()
    n = keys.count()
    bits = -(-max(n, 1) * bits_per_key // 64) * 64
    if bits > max_bits:
        return None
    place = keys.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("place"))
    masks = place.select(F.shiftright("place", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int")).alias("mask"))
    empty = dim.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = masks.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    table = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("words"))

    def may_have(key: Column) -> Column:
        found = table.scalar()
        tests = [F.call_function("shiftrightunsigned", F.get(found, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
                 for p in _places(key, bits)]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out
    return may_have


def dimension_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, replicate_bytes: int = REPLICATED_BYTES,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """Inner join of a large table with a dimension that keeps few of its rows.

    A dimension of a checked size is copied to the executors.  A larger one is
    joined by a shuffle, and the facts are thinned out before theirs by a
    Bloom filter of the dimension's keys; beyond a filter of ``max_bits``, all are shuffled."""
    on = facts[fact_key] == dim[dim_key]
    if measured_bytes(dim) <= replicate_bytes:
        return facts.join(F.broadcast(dim), on)
    may_have = key_filter(dim, dim_key, max_bits=max_bits)
    # keys are hashed as one type on both sides
    kind = dim.schema[dim_key].dataType
    thinned = facts if may_have is None else facts.where(may_have(facts[fact_key].cast(kind)))
    return thinned.join(dim, thinned[fact_key] == dim[dim_key])
