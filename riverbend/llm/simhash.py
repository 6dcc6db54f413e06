"""SimHash near-duplicates by BK-trees.

A BK-tree keeps each child under the integer Hamming distance to its parent;
a search within radius r at distance d from a node follows only the edges
d - r .. d + r (triangle inequality).  One tree over all fingerprints would
grow with the corpus, and so would a broadcast of it.  The fingerprints are
therefore sharded by the pigeonhole rule: of ``radius + 1`` bit blocks, two
fingerprints within the radius agree on at least one.  Each shard holds the
fingerprints with one block value and gets its own tree, sent only to the
task that searches that shard.  A shard over ``tree_size`` is split again by
the blocks of its other bits, and what is still larger is cut into several
trees, each searched by the whole shard.  No link is lost.

Exact copies of a fingerprint count once.  In each task the links found are
merged at once (a link to the smallest fingerprint of its local group), so
the output has at most one edge for each row, however dense a group is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_bytes, ranges, small_batches, whole_groups
from riverbend.llm.components import connected_components
from riverbend.session import save

BITS = 64
FRONTIER = 1 << 20


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of UTF-8 text, A-Z lower-cased."""
    words = data.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1:].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str | Column], text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint as a signed long) of each row.
    A null text counts as empty: fingerprint 0."""
    source = docs.select(*keys, F.col(text_col).alias("_text"))
    names = source.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in as_bytes(batch.column("_text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*names, "fp"])

    schema = source.drop("_text").schema.add("fp", "long")
    return source.mapInArrow(run, schema)


class BKForest:
    """BK-trees of many shards in flat arrays, built and searched level by level."""

    def __init__(self, fps: np.ndarray, shard: np.ndarray):
        """``fps``: distinct within a shard; ``shard``: ascending shard numbers."""
        self.fps = fps
        first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.empty(0, np.int64)
        self.roots = dict(zip(shard[first].tolist(), first.tolist(), strict=True))
        parent = np.repeat(first, np.diff(np.append(first, len(fps))))
        rest = np.setdiff1d(np.arange(len(fps)), first, assume_unique=True)
        edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(rest):
            up = parent[rest]
            d = np.bitwise_count(fps[rest] ^ fps[up]).astype(np.int64)
            order = np.lexsort((rest, d, up))
            rest, up, d = rest[order], up[order], d[order]
            head = np.concatenate(([True], (up[1:] != up[:-1]) | (d[1:] != d[:-1])))
            edges.append((up[head], d[head], rest[head]))
            parent[rest] = np.repeat(rest[head], np.diff(np.append(np.flatnonzero(head), len(rest))))
            rest = rest[~head]
        up, d, child = (np.concatenate(x) if edges else np.empty(0, np.int64) for x in (zip(*edges, strict=True) if edges else ((), (), ())))
        order = np.lexsort((d, up))
        self.edge, self.child = d[order], child[order]
        self.at = np.searchsorted(up[order], np.arange(len(fps) + 1))

    def search(self, query: np.ndarray, start: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query index, node) within ``radius``; ``start``: each query's root."""
        pending = [(np.arange(lo, min(lo + 8192, len(query))), start[lo:lo + 8192]) for lo in range(0, len(query), 8192)]
        while pending:
            q, node = pending.pop()
            if len(q) > FRONTIER:  # bounded memory: halves are searched one after the other
                half = len(q) // 2
                pending += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = np.bitwise_count(query[q] ^ self.fps[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            n = self.at[node + 1] - self.at[node]
            edges = ranges(self.at[node], n)
            q, d = np.repeat(q, n), np.repeat(d, n)
            follow = np.abs(self.edge[edges] - d) <= radius
            if follow.any():
                pending.append((q[follow], self.child[edges[follow]]))


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the groups of a[i] and b[i]; a label is the smallest index of its group."""
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(labels, high, low)
        while (up := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = up


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "shard"):
            shard = part.column("shard").to_numpy()
            fps = part.column("fp").to_numpy().view(np.uint64)
            member = np.flatnonzero(part.column("member").to_numpy())
            forest = BKForest(fps[member], shard[member])
            start = np.array([forest.roots.get(s, -1) for s in shard.tolist()], np.int64)
            query = np.flatnonzero(start >= 0)
            labels = np.arange(len(fps))
            for q, node in forest.search(fps[query], start[query], radius):
                _merge(labels, query[q], member[node])
            moved = np.flatnonzero(labels != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(fps[moved].view(np.int64)), pa.array(fps[labels[moved]].view(np.int64))], names=["a", "b"])

    return run


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    cut = np.linspace(0, len(bits), n + 1).astype(int).tolist()
    return [bits[a:b] for a, b in pairwise(cut)]


def _part(fp: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))


def _with_size(df: DataFrame, key: str) -> DataFrame:
    return df.join(df.groupBy(key).agg(F.count("*").alias("size")), key).where("size > 1")


def links(fps: DataFrame, radius: int = 3, tree_size: int = 4096) -> DataFrame:
    """Edges (a, b) that join all of ``fps`` (distinct, column ``fp``) at
    ``radius`` or fewer differing bits: a spanning set of the links, not all pairs."""
    fp = F.col("fp")
    blocks = _blocks(list(range(BITS)), radius + 1)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _part(fp, bits).alias("v")) for i, bits in enumerate(blocks)])).alias("k"))
    keyed = _with_size(keyed.select("fp", F.col("k.i").alias("i"), F.xxhash64("k.i", "k.v").alias("shard")), "shard")
    narrow = F.lit(None).cast("array<bigint>")
    for i, bits in enumerate(blocks):
        others = _blocks([b for b in range(BITS) if b not in bits], radius + 1)
        narrow = F.when(F.col("i") == i, F.array(*[F.xxhash64("shard", F.lit(j), _part(fp, more)) for j, more in enumerate(others)])).otherwise(narrow)
    hot = keyed.where(F.col("size") > tree_size).select("fp", F.explode(narrow).alias("shard"))
    hot = _with_size(hot, "shard").select("fp", "shard", F.ceil(F.col("size") / tree_size).cast("int").alias("n"))
    hot = (hot.select("fp", "shard", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("c"))
           .select("fp", F.when(F.col("n") == 1, F.col("shard")).otherwise(F.xxhash64("shard", "c")).alias("shard"),
                   (F.pmod(F.xxhash64("fp"), F.col("n")) == F.col("c")).alias("member")))
    shards = keyed.where(F.col("size") <= tree_size).select("fp", "shard", F.lit(True).alias("member")).unionByName(hot)
    return (shards.repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(_links(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, tree_size: int = 4096) -> DataFrame:
    """One row for each row of ``docs``: the id, ``text_hash`` (xxhash64 of the
    text), ``fp``, ``group_fp`` (the smallest fingerprint reachable) and
    ``component_id``, the smallest id reachable over links of at most
    ``radius`` differing bits, itself included.

    Null or empty texts have fingerprint 0 and are linked like any other.
    Rows with a null id are linked too; their component is null where no row
    of the group has an id.  Repeated rows give repeated results.
    """
    small_batches(docs.sparkSession)
    rows, _ = save(fingerprints(docs, [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("text_hash")],
                                text_col, shingle), "simhash")
    groups, _ = save(rows.groupBy("fp").agg(F.min("_id").alias("least")), "simhash-distinct")
    roots = connected_components(links(groups.select("fp"), radius, tree_size))
    linked = groups.join(roots, groups["fp"] == roots["node"]).select("fp", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    linked = linked.select("fp", "root").join(smallest, "root")
    ids = groups.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group_fp"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component_id"))
    return rows.join(ids, "fp").select(F.col("_id").alias(id_col), "text_hash", "fp", "group_fp", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
          radius: int = 3, tree_size: int = 4096) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row of the
    smallest id (null ids last; ties: the smallest text hash).  All columns stay."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius, tree_size)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_hash").alias("h")))
    kept = found.groupBy("group_fp").agg(first.alias("k")).select(F.col("k.id").alias("id"), F.col("k.h").alias("h"))
    # one long key, so that the texts are shuffled once for the join and the row number
    kept = kept.select(F.xxhash64("id", "h").alias("key"), F.struct("id", "h").alias("kept"))
    # a row's columns are fields of one, so that no name clashes
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.xxhash64(F.col(text_col)).alias("h")).withColumn("id", F.col("row").getField(id_col))
    keyed = keyed.select("row", "h", "id", F.xxhash64("id", "h").alias("key"))
    # against chance equality of keys; written as ranges, as further equalities would become join keys too
    same = F.col("h").between(F.col("kept.h"), F.col("kept.h"))
    same &= F.coalesce("id", F.lit(0)).between(F.coalesce("kept.id", F.lit(0)), F.coalesce("kept.id", F.lit(0)))
    own = keyed.join(kept, "key").where(same)
    own = own.withColumn("nth", F.expr("row_number() over (partition by key order by h)"))
    return own.where("nth = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def simhash_table(docs: DataFrame) -> DataFrame:
    """The digest of ``op10_simhash``."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
