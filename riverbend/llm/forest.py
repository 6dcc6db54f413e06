"""Approximate nearest neighbours by a forest of sorted hash-prefix arrays.

Each tree hashes a vector to a string of ``BITS`` signs of random projections
and keeps its strings as one sorted array, which stands for the prefix tree:
the vectors below a node are a range of it.  A query descends in all trees to
its longest matching prefix, then ascends in all of them together, one bit
at a time, until the nodes reached hold ``share`` of the vectors (counted
with repeats).  What they hold is ranked by exact inner product in double
precision.  Vectors get one more component so that they are all as long as
the longest, which makes largest inner product and smallest angle the same.

Vectors are dealt by hash to shards of about ``shard_size``; each shard has
its own forest, built in the task that searches it, so every row is indexed.
The queries are dealt by hash to blocks of about ``asked_size``, and each
shard meets each block in a group of its own, with its vectors sent once for
each block: a task holds one shard and one block, however large the table.
Equal vectors are one entry with its smallest
ids, as many as a result can show, so a vector held by a third of all rows
costs no more than any other.

``share`` is what decides the recall.  Its default is set for vectors without
any structure (random directions in 64 dimensions, 0.9 and more in the
tests), where even the nearest neighbours are far away; clustered vectors
are found with a small fraction of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import whole_groups
from riverbend.session import save

TREES = 48
BITS = 24
SHARE = 0.6
SHARD_SIZE = 16_384
ASKED_SIZE = 16_384
QUERY_BLOCK = 1024


class PrefixForest:
    def __init__(self, vectors: np.ndarray, longest: float, trees: int = TREES, bits: int = BITS, seed: int = 7):
        """``longest``: the largest norm of all vectors, in every shard the same."""
        self.vectors, self.bits = vectors, bits
        rest = np.sqrt(np.maximum(0, longest**2 - np.einsum("ij,ij->i", vectors, vectors)))
        self.planes = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, trees * bits)).astype(np.float32)
        codes = self.hash(np.column_stack([vectors, rest]))
        self.order = np.argsort(codes, axis=0, kind="stable").T.copy()
        self.codes = np.take_along_axis(codes, self.order.T, axis=0).T.copy()
        self.single = vectors.astype(np.float32)

    def hash(self, vectors: np.ndarray) -> np.ndarray:
        """(vector, tree): the strings as integers."""
        out = np.empty((len(vectors), self.planes.shape[1] // self.bits), np.int64)
        weights = 1 << np.arange(self.bits - 1, -1, -1)
        for lo in range(0, len(vectors), 4096):
            signs = vectors[lo:lo + 4096].astype(np.float32) @ self.planes > 0
            out[lo:lo + 4096] = signs.reshape(len(signs), -1, self.bits) @ weights
        return out

    def ranges(self, queries: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, tree): the range of the node each query stops at."""
        codes = self.hash(np.column_stack([queries, np.zeros(len(queries))]))
        lo, hi = np.zeros(codes.shape, np.int64), np.full(codes.shape, self.codes.shape[1], np.int64)
        open_ = np.arange(len(queries))
        for depth in range(self.bits, 0, -1):
            first = codes[open_] >> (self.bits - depth) << (self.bits - depth)
            last = first + (1 << (self.bits - depth))
            a, b = np.empty_like(first), np.empty_like(first)
            for t, own in enumerate(self.codes):
                a[:, t], b[:, t] = np.searchsorted(own, first[:, t]), np.searchsorted(own, last[:, t])
            done = (b - a).sum(axis=1) >= wanted
            lo[open_[done]], hi[open_[done]] = a[done], b[done]
            open_ = open_[~done]
            if not len(open_):
                break
        return lo, hi

    def search(self, queries: np.ndarray, k: int, share: float = SHARE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the entries found, best first, and their inner products;
        more than k only where the k-th has equals."""
        n = len(self.vectors)
        # an entry counts once for each tree, so these are 2 k others at least; all, where there are fewer
        lo, hi = self.ranges(queries, max(share * n, len(self.codes) * (2 * k + 1)))
        seen = np.zeros(n, bool)
        for q, a, b in zip(queries, lo.tolist(), hi.tolist(), strict=True):
            seen[:] = False
            for order, x, y in zip(self.order, a, b, strict=True):
                seen[order[x:y]] = True
            found = np.flatnonzero(seen)
            if len(found) > 2 * k:  # single precision decides only what is far below the k-th
                near = self.single[found] @ q.astype(np.float32)
                least = np.partition(near, len(near) - k)[len(near) - k]
                found = found[near >= least - 1e-4 * (1 + np.abs(near).max())]
            scores = self.vectors[found] @ q
            best = np.lexsort((found, -scores))
            cut = len(best) if len(best) <= k else int(np.searchsorted(-scores[best], -scores[best[k - 1]], "right"))
            yield found[best[:cut]], scores[best[:cut]]


def _valid(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """Id and float64 bytes of the rows of a batch that take part."""
    for i, v in zip(batch.column("id").to_pylist(), batch.column("v"), strict=True):
        if i is None or not v.is_valid or not len(v) or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0 becomes 0
        if np.isfinite(x).all() and x.any():
            yield i, x.tobytes()


def _distinct(rows: DataFrame, kept: int) -> DataFrame:
    """(vec, ids): each vector as float64 bytes with its ``kept`` smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, set[int]] = {}
            for i, x in _valid(batch):
                found.setdefault(x, set()).add(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array([sorted(x)[:kept] for x in found.values()], pa.list_(pa.int64()))], names=["vec", "ids"])

    # for each vector a task sends `kept` ids at most for each batch it has read
    out = rows.mapInArrow(run, "vec binary, ids array<long>")
    return out.groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, kept).alias("ids"))


def _asked(rows: DataFrame, size: int) -> DataFrame:
    """(id, vec) of the queries, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(i, x) for i, x in _valid(batch) if len(x) == size]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in own], pa.int64()), pa.array([x for _, x in own], pa.binary())], names=["id", "vec"])

    return rows.select("id", "v").mapInArrow(run, "id long, vec binary").distinct()


def _search(longest: float, k: int, share: float, trees: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "part"):
            parts = part.column("part").to_numpy()
            for s in np.unique(parts).tolist():
                own = part.filter(pa.array(parts == s))
                query = own.column("query").to_numpy()
                vectors = np.frombuffer(b"".join(own.column("vec").to_pylist()), np.float64).reshape(len(query), -1)
                ids = own.column("ids").filter(pa.array(query < 0)).combine_chunks()
                entries, asked, numbers = vectors[query < 0], vectors[query >= 0], query[query >= 0]
                if not len(entries):
                    continue
                forest = PrefixForest(entries, longest, trees, bits)
                for lo in range(0, len(asked), QUERY_BLOCK):
                    found = list(forest.search(asked[lo:lo + QUERY_BLOCK], k, share))
                    entry = np.concatenate([e for e, _ in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(numbers[lo:lo + QUERY_BLOCK], [len(e) for e, _ in found])), pa.array(np.concatenate([x for _, x in found])), ids.take(pa.array(entry))],
                        names=["query", "score", "ids"])

    return run


def _dealt(entries: DataFrame, unique: DataFrame, shards: int, blocks: int) -> DataFrame:
    """(vec, ids, query, part): each shard of the entries (query -1) with each block of the queries, as one part."""

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    shard, block = F.pmod(F.xxhash64("vec"), F.lit(shards)), F.pmod(F.xxhash64("vec", F.lit("block")), F.lit(blocks))
    asked = unique.select("vec", F.lit(None).cast("array<long>").alias("ids"), "query", block.alias("block"), numbers(shards).alias("shard"))
    held = entries.select("vec", "ids", F.lit(-1).cast("long").alias("query"), numbers(blocks).alias("block"), shard.alias("shard"))
    return held.unionByName(asked).select("vec", "ids", "query", (F.col("shard") * blocks + F.col("block")).alias("part"))


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            share: float = SHARE, shard_size: int = SHARD_SIZE, trees: int = TREES, bits: int = BITS,
            asked_size: int = ASKED_SIZE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row where
    ``queries`` holds, among all rows but its own; ties go to the smaller id.

    Rows with a null id, or a vector that is null, empty, zero, or holds null
    or non-finite components, take no part; nor do vectors of another length
    than the most frequent (ties: the longest).  Repeated ids with one vector
    count once.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    entries, _ = save(_distinct(rows.select("id", "v"), k + 1), "vectors")
    size = F.octet_length("vec")
    sizes = entries.groupBy(size.alias("size")).agg(F.sum(F.size("ids")).alias("n"), F.count("*").alias("distinct")).orderBy(F.desc("n"), F.desc("size")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    entries = entries.where(size == sizes["size"])

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array([np.sqrt(np.einsum("ij,ij->i", x, x).max())] if len(x) else [], pa.float64())], names=["norm"])

    longest = entries.select("vec").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]
    shards = max(1, -(-sizes["distinct"] // shard_size))
    # all ids of a query vector are asked as one: by its smallest query id
    asked = _asked(rows.where("q"), sizes["size"])
    asked, _ = save(asked, "vector-queries")
    unique = asked.groupBy("vec").agg(F.min("id").alias("query"))
    blocks = max(1, -(-unique.count() // asked_size))
    dealt = _dealt(entries, unique, shards, blocks).repartition(shards * blocks, "part").sortWithinPartitions("part", "query", "vec")
    found = dealt.mapInArrow(_search(longest, k + 1, share, trees, bits), "query long, score double, ids array<long>")
    # k + 1 of each query vector, as a row leaves out at most itself
    one = found.select("query", "score", F.explode("ids").alias("vec_id"))
    best = one.withColumn("n", F.expr("row_number() over (partition by query order by score desc, vec_id)")).where(F.col("n") <= k + 1)
    numbers = asked.join(unique.select("vec", "query"), "vec").select("query", F.col("id").alias("query_id"))
    out = numbers.join(best, "query").where("query_id <> vec_id")
    out = out.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

