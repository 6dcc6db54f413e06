"""Growing random forests from sparse rows.

``RandomForestClassifier`` turns a row into a number for every feature (64 KB
at 2^14 features) and each task gathers dense counts of all bins of all
features of every node it splits (0.8 GB for 100 trees eight levels deep), which
are shuffled whole.  Here a row keeps its terms only, and a task sends only the
counts that are not 0.  The draws, bins, nodes and gains are those of Spark's
own forest, so ``SparseForest`` grows the trees that its estimator grows:

* rows are drawn for each tree by a Poisson generator seeded per partition
  (``bootstrap_counts``), so they depend on the rows' order and partitions;
* thresholds come from a sample of some 10,000 rows (``sampled``, ``thresholds``);
* a node's features are a reservoir sample seeded from the forest's generator,
  in the order in which nodes are split (``reservoirs``, ``tree_order``).

A level of all trees is one job: tasks route their rows and count, and the
counts of ``UNIT`` nodes at a time are added up and searched for the best
split.  Only the splits reach the driver.
"""

from __future__ import annotations

import json
import math
import threading
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.operators.forests import Forest, vector_parts
from riverbend.session import release, save, scratch_path

#: Rows of a record: their bins lie in a task as a dense array of bytes (8 MB at 2^14 features).
BLOCK = 512
#: Nodes whose counts are added up and searched together.
UNIT = 64
#: Drawn rows of trees that are looked up together, and counts that a task holds before it adds them up and sends them.
PAIRS = 1024
HELD = 1 << 22
#: A term is looked up in the slots that have it where that makes less than this share of the lookups of a slot's features.
SPARSE = 0.25
#: Generators that step together: partitions of a drawing task, and nodes of a reservoir.
LANES = 16
NODE_LANES = 512
#: Groups of features whose thresholds are set by one task.
SHARDS = 16
# Fixed values of Spark's forest: rows sampled for thresholds, the largest rate drawn by gaps, the smallest draw of a gap, an impurity that counts as 0.
SPLIT_ROWS = 10_000
GAP_RATE = 0.4
GAP_LEAST = 5e-11
EPSILON = 2.0 ** -52


# ------------------------------------------------------------------ generators

def java_longs(seed: int) -> Iterator[int]:
    """``java.util.Random(seed).nextLong()``, again and again."""
    state, mask = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), (1 << 48) - 1
    while True:
        state = (state * 0x5DEECE66D + 0xB) & mask
        high = state >> 16
        state = (state * 0x5DEECE66D + 0xB) & mask
        low = state >> 16
        value = (((high - (high >> 31 << 32)) << 32) + (low - (low >> 31 << 32))) & ((1 << 64) - 1)
        yield value - (value >> 63 << 64)


def _murmur(words: Sequence[np.ndarray], seed) -> np.ndarray:
    """MurmurHash3 (32 bits) of two words each."""
    h = np.broadcast_to(np.asarray(seed, np.uint32), words[0].shape).copy()
    for k in words:
        k = k * np.uint32(0xCC9E2D51)
        k = ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)
        h ^= k
        h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def xorshift_states(seeds: Sequence[int]) -> np.ndarray:
    """States of Spark's ``XORShiftRandom`` for these seeds."""
    big = np.array([s & ((1 << 64) - 1) for s in seeds], np.uint64)
    words = [(big >> np.uint64(32)).astype(np.uint32).byteswap(), (big & np.uint64(0xFFFFFFFF)).astype(np.uint32).byteswap()]
    low = _murmur(words, np.uint32(1007110753))
    return (_murmur(words, low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _step(state: np.ndarray) -> None:
    state ^= state << np.uint64(21)
    state ^= state >> np.uint64(35)
    state ^= state << np.uint64(4)


def _draw(state: np.ndarray) -> np.ndarray:
    """The next number in [0, 1) of each generator."""
    _step(state)
    high = (state & np.uint64((1 << 26) - 1)) << np.uint64(27)
    _step(state)
    return (high + (state & np.uint64((1 << 27) - 1))).astype(float) * 2.0 ** -53


def first_int(seed: int) -> int:
    """The first ``nextInt()`` of an ``XORShiftRandom``."""
    state = xorshift_states([seed])
    _step(state)
    value = int(state[0]) & 0xFFFFFFFF
    return value - (value >> 31 << 32)


def reservoirs(seeds: Sequence[int], n: int, k: int) -> np.ndarray:
    """For each seed the reservoir sample of ``k`` of the numbers below ``n``, in the reservoir's order."""
    state, held = xorshift_states(seeds), np.tile(np.arange(k, dtype=np.int32), (len(seeds), 1))
    for item in range(k, n):
        place = _draw(state) * float(item + 1)
        hit = np.flatnonzero(place < k)
        if len(hit):
            held[hit, place[hit].astype(np.int64)] = item
    return held


@lru_cache(maxsize=1)
def _jumps() -> list[tuple[np.ndarray, np.ndarray]]:
    """How an output of the Well generator enters the one 1, 2, 4, ... 32 steps on: tables of its low and high 16 bits."""
    def once(x):
        p = x ^ (x << np.uint32(25))
        return (p << np.uint32(9)) ^ (p >> np.uint32(21))
    word = np.arange(1 << 16, dtype=np.uint32)
    low, high = once(word), once(word << np.uint32(16))
    out = []
    for _ in range(6):
        out.append((low, high))
        low, high = (low[t & np.uint32(0xFFFF)] ^ high[t >> np.uint32(16)] for t in (low, high))
    return out


def well_doubles(seeds: Sequence[int]) -> Iterator[np.ndarray]:
    """``Well19937c(seed).nextDouble()`` of several generators side by side, (generators, 1024) at a time.

    Outputs are made 64 at once: but for the output just before, a step reads words of 70 steps ago or older."""
    u, lanes = np.uint32, len(seeds)
    v = np.zeros((lanes, 624), np.uint32)
    for lane, seed in enumerate(seeds):
        words = [(seed >> 32) & 0xFFFFFFFF, seed & 0xFFFFFFFF]
        for i in range(2, 624):
            l = words[i - 2] - (words[i - 2] >> 31 << 32)
            words.append((1812433253 * (l ^ (l >> 30)) + i) & 0xFFFFFFFF)
        v[lane] = words
    # h holds the words of former steps, the oldest first: word j of the seed is as old as j steps
    rounds = 32
    h = np.zeros((lanes, 624 + 64 * rounds), np.uint32)
    h[:, 1:624] = v[:, :0:-1]
    last = v[:, 0].copy()
    jumps = _jumps()
    while True:
        z = np.empty((lanes, 64 * rounds), np.uint32)
        for r in range(rounds):
            n = 624 + 64 * r  # column of the first new word
            m1, m2, m3 = h[:, n - 70:n - 6], h[:, n - 179:n - 115], h[:, n - 449:n - 385]
            q = m1 ^ (m1 >> u(27))
            z2 = (m2 >> u(9)) ^ m3 ^ (m3 >> u(1))
            qz = q ^ z2
            a = (h[:, n - 623:n - 559] & u(0x80000000)) ^ (h[:, n - 622:n - 558] & u(0x7FFFFFFF)) ^ (q << u(9)) ^ (z2 << u(21)) ^ (qz >> u(21))
            low, high = jumps[0]
            a[:, 0] ^= low[last & u(0xFFFF)] ^ high[last >> u(16)]
            for k, (low, high) in enumerate(jumps):
                s = 1 << k
                before = a[:, :-s]
                a[:, s:] ^= low[before & u(0xFFFF)] ^ high[before >> u(16)]
            v0 = np.empty_like(a)
            v0[:, 0], v0[:, 1:] = last, a[:, :-1]
            h[:, n:n + 64] = v0 ^ (v0 << u(25)) ^ qz
            last = a[:, -1].copy()
            z[:, 64 * r:64 * r + 64] = a
        h[:, :624] = h[:, -624:]
        z ^= (z << u(7)) & u(0xE46E1700)
        z ^= (z << u(15)) & u(0x9B868000)
        bits = (z >> u(6)).astype(np.int64)
        yield ((bits[:, 0::2] << 26) | bits[:, 1::2]) * 2.0 ** -52


def poisson_counts(seeds: Sequence[int], sizes: Sequence[int]) -> list[np.ndarray]:
    """For each seed its first draws of a Poisson count of mean 1, as commons-math makes them."""
    stop = math.exp(-1.0)
    found = [[] for _ in seeds]
    left, rest = list(sizes), [np.zeros(0) for _ in seeds]
    for block in well_doubles(seeds) if max(sizes, default=0) else ():
        for lane, fresh in enumerate(block):
            if left[lane] <= 0:
                continue
            x = np.concatenate([rest[lane], fresh])
            product, count = x.copy(), np.zeros(len(x), np.int64)  # from each number on: how many go before the product falls below e^-1
            at = np.flatnonzero(product >= stop)
            while len(at):
                count[at] += 1
                at = at[at + count[at] < len(x)]
                product[at] *= x[at + count[at]]
                at = at[product[at] >= stop]
            steps, here, starts = (np.arange(len(x)) + count + 1).tolist(), 0, []
            while here < len(x) and steps[here] <= len(x):
                starts.append(here)
                here = steps[here]
            rest[lane] = x[here:]
            got = count[starts[:left[lane]]].astype(np.uint8)
            left[lane] -= len(got)
            found[lane].append(got)
        if max(left) <= 0:
            break
    return [np.concatenate(f) if f else np.zeros(0, np.uint8) for f in found]


def sampled(n: int, fraction: float, seed: int) -> np.ndarray:
    """Which of a partition's ``n`` rows Spark's Bernoulli sampler takes."""
    if fraction >= 1.0:
        return np.ones(n, bool)
    taken, state, mask = np.zeros(n, bool), int(xorshift_states([seed])[0]), (1 << 64) - 1

    def draw() -> float:
        nonlocal state
        parts = []
        for _ in range(2):
            state ^= (state << 21) & mask
            state ^= state >> 35
            state ^= (state << 4) & mask
            parts.append(state)
        return (((parts[0] & ((1 << 26) - 1)) << 27) + (parts[1] & ((1 << 27) - 1))) * 2.0 ** -53

    if fraction > GAP_RATE:
        for i in range(n):
            taken[i] = draw() <= fraction
        return taken
    share, at = math.log1p(-fraction), 0
    while True:
        at += int(math.log(max(draw(), GAP_LEAST)) / share)
        if at >= n:
            return taken
        taken[at] = True
        at += 1


# ------------------------------------------------------------------ bins

def thresholds(values: np.ndarray, rows: float, bins: int) -> list[float]:
    """The thresholds of a feature from its values other than 0 in a sample of ``rows`` rows (the expected number)."""
    distinct, counts = np.unique(values, return_counts=True)
    if not len(distinct):
        return []
    x, n = distinct.tolist(), counts.astype(float).tolist()
    zeros = rows - float(len(values))
    if zeros > EPSILON * len(values) * 100:
        at = int(np.searchsorted(distinct, 0.0))
        x.insert(at, 0.0)
        n.insert(at, zeros)
    if len(x) <= bins:
        return [(a + b) / 2.0 for a, b in zip(x, x[1:])]
    stride, out = rows / bins, []
    count, target, total = n[0], stride, sum(n)
    for i in range(1, len(x)):
        if target > total + 1:  # no later value comes closer than the one before
            break
        before, count = count, count + n[i]
        if abs(before - target) < abs(count - target):
            out.append((x[i - 1] + x[i]) / 2.0)
            target += stride
    return out


class Bins(NamedTuple):
    """Thresholds of all features, one after another: those of feature f lie from ``first[f]`` to ``first[f + 1]``."""
    first: np.ndarray
    value: np.ndarray

    @property
    def zero(self) -> np.ndarray:
        """The bin of the value 0 of each feature."""
        f = np.arange(len(self.first) - 1)
        return self.of(f, np.zeros(len(f)))

    @property
    def most(self) -> int:
        """The number of bins of the feature with the most."""
        return int(np.diff(self.first).max(initial=0)) + 1

    def of(self, feature: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The bin of each value: the number of the feature's thresholds below it."""
        low, high = self.first[feature], self.first[feature + 1]
        start = low
        for _ in range(self.most.bit_length()):
            middle = (low + high) >> 1
            open_ = low < high
            below = open_ & (self.value[np.minimum(middle, max(len(self.value) - 1, 0))] < x) if len(self.value) else open_
            low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
        return low - start


def _split(vectors: DataFrame, label: str, features: str) -> DataFrame:
    v = F.unwrap_udt(features)
    return vectors.select(F.col(label).cast("double").alias("label"), v["size"].alias("size"), v["indices"].alias("indices"), v["values"].alias("values"))


class Shape(NamedTuple):
    rows: dict[int, int]  # of each partition
    features: int
    classes: int


def shape_of(split: DataFrame) -> Shape:
    """The rows of each partition, the width of the vectors and the number of classes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, top, odd, size = 0, -1.0, False, 0
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            if not len(label):
                continue
            n += len(label)
            top, odd = max(top, float(label.max())), odd or not bool((np.floor(label) == label).all()) or float(label.min()) < 0
            sizes = batch.column("size")
            size = max(size, sizes[0].as_py() or len(batch.column("values")[0]))
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([n], pa.int64()),
                                          "top": pa.array([top]), "odd": pa.array([odd]), "size": pa.array([size], pa.int32())})

    found = split.mapInArrow(count, "part int, n long, top double, odd boolean, size int").collect()
    if not sum(r["n"] for r in found):
        raise ValueError("a forest needs rows to grow from")
    if any(r["odd"] for r in found):
        raise ValueError("labels are 0, 1, 2, ...")
    return Shape({r["part"]: r["n"] for r in found}, max(r["size"] for r in found), int(max(r["top"] for r in found)) + 1)


def bins_of(split: DataFrame, shape: Shape, max_bins: int, seed: int) -> Bins:
    """Thresholds of all features, from all rows or a sample of some ``SPLIT_ROWS``."""
    n = sum(shape.rows.values())
    bins = min(max_bins, n)
    wanted = max(bins * bins, SPLIT_ROWS)
    fraction = wanted / n if wanted < n else 1.0
    seeds = list(islice(java_longs(first_int(seed)), max(shape.rows) + 1))
    sizes = shape.rows

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        part, at = TaskContext.get().partitionId(), 0
        taken = sampled(sizes[part], fraction, seeds[part])
        for batch in batches:
            own, at = taken[at:at + len(batch)], at + len(batch)
            lens, feature, value = vector_parts(batch.column("indices"), batch.column("values"))
            keep = np.repeat(own, lens) & (value != 0)
            feature, value = feature[keep], value[keep]
            shard = feature % SHARDS
            for s in np.unique(shard).tolist():
                mine = shard == s
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "feature": pa.array([feature[mine].astype(np.int32).tobytes()], pa.binary()),
                                                  "value": pa.array([value[mine].tobytes()], pa.binary())})

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        feature = np.concatenate([np.frombuffer(b, np.int32) for b in rows["feature"]])
        value = np.concatenate([np.frombuffer(b) for b in rows["value"]])
        order = np.argsort(feature, kind="stable")
        feature, value = feature[order], value[order]
        first = np.flatnonzero(np.diff(feature, prepend=-1))
        return pd.DataFrame([(int(feature[a]), thresholds(value[a:b], fraction * n, bins)) for a, b in zip(first, [*first[1:], len(feature)])], columns=["feature", "at"])

    found = split.mapInArrow(take, "shard int, feature binary, value binary").groupBy("shard").applyInPandas(cut, "feature int, at array<double>").collect()
    each = [[] for _ in range(shape.features)]
    for r in found:
        each[r["feature"]] = r["at"]
    return Bins(np.concatenate([[0], np.cumsum([len(t) for t in each])]).astype(np.int64), np.array([t for own in each for t in own], float))


# ------------------------------------------------------------------ rows

class Counts(NamedTuple):
    """How often each tree draws each row: a saved table of (part, block, counts), of so many trees and rows of each partition."""
    table: DataFrame
    path: str
    trees: int
    rows: dict[int, int]

    def cover(self, rows: dict[int, int], trees: int) -> bool:
        return trees == self.trees and all(n <= self.rows.get(part, 0) for part, n in rows.items())


def bootstrap_counts(spark: SparkSession, rows: dict[int, int], trees: int, seed: int) -> Counts:
    """The draws for partitions of so many rows.  Fewer rows of a partition have the first of its draws."""
    full = sorted((part, n) for part, n in rows.items() if n)
    tasks = [full[at:at + LANES] for at in range(0, len(full), LANES)]

    def draw(task: list[tuple[int, int]]) -> Iterator[tuple[int, int, bytes]]:
        for (part, n), found in zip(task, poisson_counts([seed + part + 1 for part, _ in task], [n * trees for _, n in task])):
            for block in range(-(-n // BLOCK)):
                yield part, block, found[block * BLOCK * trees:(block + 1) * BLOCK * trees].tobytes()

    drawn = spark.sparkContext.parallelize(tasks, max(1, len(tasks))).flatMap(draw)
    table, path = save(spark.createDataFrame(drawn, "part int, block int, counts binary"), "forest-draws")
    return Counts(table, path, trees, dict(rows))


ROWS_DDL = "part int, block int, label binary, terms binary, feature binary, bin binary"


def binned(split: DataFrame, bins: Bins) -> DataFrame:
    """Blocks of rows: their classes, and of each row the features whose bin is not that of 0, with the bin's distance from it (modulo 256)."""
    sent = split.sparkSession.sparkContext.broadcast((bins, bins.zero))
    kind = np.uint16 if len(bins.first) <= 1 << 16 else np.uint32
    if bins.most > 256:
        raise ValueError("256 bins at most")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bins, zero), part, block = sent.value, TaskContext.get().partitionId(), 0

        def record(pieces: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            label, lens, feature, away = (np.concatenate(c) for c in zip(*pieces))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "label": pa.array([label.astype(np.int32).tobytes()], pa.binary()),
                "terms": pa.array([lens.astype(np.uint32).tobytes()], pa.binary()), "feature": pa.array([feature.astype(kind).tobytes()], pa.binary()),
                "bin": pa.array([away.astype(np.uint8).tobytes()], pa.binary())})

        held, n = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                some = batch.slice(at, BLOCK - n)
                at, n = at + len(some), n + len(some)
                label = some.column("label").to_numpy(zero_copy_only=False)
                lens, feature, value = vector_parts(some.column("indices"), some.column("values"))
                away = bins.of(feature, value) - zero[feature]
                keep = away != 0
                row = np.repeat(np.arange(len(label)), lens)[keep]
                held.append((label, np.bincount(row, minlength=len(label)), feature[keep], away[keep]))
                if n == BLOCK:
                    yield record(held)
                    held, n, block = [], 0, block + 1
        if held:
            yield record(held)

    return split.mapInArrow(pack, ROWS_DDL)


# ------------------------------------------------------------------ levels

class Level(NamedTuple):
    """What a pass needs: the trees so far (nodes of all of them, the right child after the left one; a leaf is its own
    child) and the features of the nodes to be split."""
    root: np.ndarray
    left: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    slot: np.ndarray  # of a node to be split, else -1
    subset: np.ndarray  # features of each slot
    zero: np.ndarray
    bins: int
    classes: int
    deep: int


class _Desk:
    """What a task keeps from block to block: arrays (fresh memory would take longer than what is done in it), and which slots have a feature."""

    def __init__(self, level: Level):
        k = level.subset.shape[1]
        self.dense = np.zeros(BLOCK * len(level.zero), np.uint8)
        self.where, self.found, self.hits = np.empty((PAIRS, k), np.int64), np.empty((PAIRS, k), np.uint8), np.empty((PAIRS, k), bool)
        self.level, self.inverse = level, None

    def slots_of(self) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``subset`` that hold each feature, and where those of a feature begin."""
        if self.inverse is None:
            flat = self.level.subset.ravel()
            self.inverse = np.argsort(flat, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(self.level.zero)))])
        return self.inverse


def _counts_of(desk: _Desk, record) -> tuple[np.ndarray, np.ndarray]:
    """Of a block of rows: packed (cell, draws) numbers of the bins hit, and draws of each class in each slot."""
    level = desk.level
    label = np.frombuffer(record.label, np.int32).astype(np.int64)
    lens = np.frombuffer(record.terms, np.uint32).astype(np.int64)
    width, trees, n, k = len(level.zero), len(level.root), len(label), level.subset.shape[1]
    feature = np.frombuffer(record.feature, np.uint16 if width < 1 << 16 else np.uint32).astype(np.int64)
    away = np.frombuffer(record.bin, np.uint8)
    entry, dense = np.repeat(np.arange(n), lens), desk.dense
    filled = entry * width + feature
    dense[filled] = away
    draws = np.ascontiguousarray(np.frombuffer(record.counts, np.uint8)[:n * trees].reshape(n, trees).T).ravel()
    pair = np.flatnonzero(draws)
    tree = pair // n
    row = pair - tree * n
    node, base = level.root[tree], row * width
    shifted = bool(level.zero.any())
    for _ in range(level.deep):
        of = level.feature.take(node)
        found = dense.take(base + of)
        if shifted:
            found = found + level.zero.take(of).astype(np.uint8)
        left = level.left.take(node)
        node = left + ((found > level.bin.take(node)) & (left != node))
    slot = level.slot.take(node)
    open_ = np.flatnonzero(slot >= 0)
    slot, base, pair, row = slot[open_], base[open_], pair[open_], row[open_]
    times, own = draws[pair].astype(np.int64), label[row]
    totals = np.bincount(slot * level.classes + own, weights=times, minlength=len(level.subset) * level.classes).astype(np.int64)
    out = []

    def hit_by(place: np.ndarray, bin_: np.ndarray, of: np.ndarray, own: np.ndarray, times: np.ndarray) -> None:
        if shifted:
            bin_ = (bin_ + level.zero[of]) & 255
        out.append((((place * level.bins + bin_) * level.classes + own) << 8) | times)

    if len(lens) and int(lens.sum()) * len(level.subset) * k < SPARSE * len(slot) * k * width:
        # few slots: each term of a row is looked up in those that have it
        places, first = desk.slots_of()
        held = np.full(trees * n, -1, np.int64)
        held[pair] = slot
        tree_at = np.zeros(len(level.subset), np.int64)
        tree_at[slot] = pair // n * n
        some = first[feature + 1] - first[feature]
        ends = np.cumsum(some)
        for a, b in _cuts(ends, PAIRS * 64):
            which = np.repeat(np.arange(a, b), some[a:b])
            place = places[np.arange(len(which)) + np.repeat(first[feature[a:b]] - (ends[a:b] - some[a:b] - (ends[a - 1] if a else 0)), some[a:b])]
            at = place // k
            spot = tree_at[at] + entry[which]
            good = np.flatnonzero(held[spot] == at)
            which, spot = which[good], spot[good]
            hit_by(place[good], away[which].astype(np.int64), feature[which], label[entry[which]], draws[spot].astype(np.int64))
    else:
        # many: the features of a row's slot are looked up in the row
        for at in range(0, len(slot), PAIRS):
            s = slot[at:at + PAIRS]
            where, found, hits = (x[:len(s)] for x in (desk.where, desk.found, desk.hits))
            level.subset.take(s, axis=0, out=where, mode="clip")
            where += base[at:at + PAIRS, None]
            dense.take(where, out=found, mode="clip")
            hit = np.flatnonzero(np.not_equal(found, 0, out=hits))
            p = hit // k
            hit_by(s[p] * k + (hit - p * k), found.ravel()[hit].astype(np.int64), where.ravel()[hit] - base[at + p], own[at + p], times[at + p])
    dense[filled] = 0
    return np.concatenate(out) if out else np.zeros(0, np.int64), totals


def _cuts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of entries, whose running total is ``ends``, of about ``most`` together."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def _small(x: np.ndarray) -> tuple[bytes, int]:
    """Numbers in as few bytes each as the largest needs, and how many these are."""
    kind = np.min_scalar_type(int(x.max(initial=0)))
    return x.astype(kind).tobytes(), kind.itemsize


def _large(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"u{size}").astype(np.int64)


CELLS_DDL = "unit int, gap binary, gap_size int, n binary, n_size int, totals binary"


def _sent(level: Level, held: list[np.ndarray], totals: np.ndarray) -> pd.DataFrame:
    """What a task has counted, a row for each unit: the distances between the cells that are not 0, and their counts."""
    packed = np.sort(np.concatenate(held))
    cell, n = packed >> 8, packed & 255
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    cell, n = cell[first], np.add.reduceat(n, first) if len(first) else n
    size, slots, out = UNIT * level.subset.shape[1] * level.bins * level.classes, len(level.subset), []
    for unit in range(-(-slots // UNIT)):
        a, b = np.searchsorted(cell, [unit * size, (unit + 1) * size])
        own = totals[unit * UNIT * level.classes:(unit + 1) * UNIT * level.classes]
        if own.any():
            out.append((unit, *_small(np.diff(cell[a:b], prepend=unit * size)), *_small(n[a:b]), own.tobytes()))
    return pd.DataFrame(out, columns=["unit", "gap", "gap_size", "n", "n_size", "totals"])


def gini(counts: np.ndarray) -> np.ndarray:
    """The impurity of class counts (the last axis), 0 without rows."""
    total, out = counts.sum(axis=-1), np.ones(counts.shape[:-1])
    safe = np.maximum(total, 1.0)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / safe
        out -= share * share
    return np.where(total == 0, 0.0, out)


class Best(NamedTuple):
    """Of each slot of a unit: its draws of each class, and its best split (gain -inf where none is valid)."""
    totals: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray


def best_splits(level: Level, unit: int, cells: np.ndarray, totals: np.ndarray, splits: np.ndarray) -> Best:
    """The best split of each node: of equal gains the first in the order of its features and of their bins."""
    k, subset = level.subset.shape[1], level.subset[unit * UNIT:(unit + 1) * UNIT]
    m = len(subset)
    cells, totals = cells.reshape(-1, level.bins, level.classes)[:m * k], totals.reshape(-1, level.classes).astype(float)
    used = np.flatnonzero(cells.any(axis=(1, 2)))
    gain, feature, at, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, level.classes))
    if len(used):
        slot, own = used // k, subset.ravel()[used]
        counts = cells[used]
        counts[np.arange(len(used)), level.zero[own]] = totals[slot] - counts.sum(axis=1)
        lower = counts.cumsum(axis=1)[:, :-1]
        upper = totals[slot][:, None] - lower
        n_lower, n_upper, n = lower.sum(axis=2), upper.sum(axis=2), totals.sum(axis=1)[slot][:, None]
        gains = gini(totals)[slot][:, None] - n_lower / n * gini(lower) - n_upper / n * gini(upper)
        valid = (n_lower >= 1) & (n_upper >= 1) & (gains >= 0) & (np.arange(level.bins - 1) < splits[own][:, None])
        gains[~valid] = -np.inf
        where = gains.argmax(axis=1)
        most = gains[np.arange(len(used)), where]
        np.maximum.at(gain, slot, most)
        first = np.flatnonzero((most == gain[slot]) & np.isfinite(most))
        which, index = np.unique(slot[first], return_index=True)
        first = first[index]
        feature[which], at[which], left[which] = own[first], where[first], lower[first, where[first]]
    return Best(totals, gain, feature, at, left)


def split_nodes(rows: DataFrame, level: Level, splits: np.ndarray) -> list[Best]:
    """The best splits of all slots, one ``Best`` for each unit, in one job."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((level, splits))
    units = -(-len(level.subset) // UNIT)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level, _ = sent.value
        held, size, totals, desk = [], 0, np.zeros(len(level.subset) * level.classes, np.int64), _Desk(level)
        for batch in batches:
            for record in batch.itertuples():
                cells, own = _counts_of(desk, record)
                held.append(cells)
                size, totals = size + len(cells), totals + own
                if size >= HELD:
                    yield _sent(level, held, totals)
                    held, size, totals = [], 0, np.zeros_like(totals)
        if held:
            yield _sent(level, held, totals)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level, splits = sent.value
        size = UNIT * level.subset.shape[1] * level.bins * level.classes
        now = cells = totals = None

        def done() -> pd.DataFrame:
            return pd.DataFrame([(now, *(np.ascontiguousarray(x).tobytes() for x in best_splits(level, now, cells, totals, splits)))], columns=["unit", *Best._fields])

        for batch in batches:
            for r in batch.itertuples():
                own = np.frombuffer(r.totals, np.int64)
                if r.unit != now:
                    if now is not None:
                        yield done()
                    now, cells, totals = r.unit, np.zeros(size), np.zeros(len(own), np.int64)
                cells[np.cumsum(_large(r.gap, r.gap_size))] += _large(r.n, r.n_size)
                totals = totals + own
        if now is not None:
            yield done()

    counted = rows.mapInPandas(count, CELLS_DDL)
    dealt = counted.repartition(min(units, spark.sparkContext.defaultParallelism), "unit").sortWithinPartitions("unit")
    found = {r["unit"]: r for r in dealt.mapInPandas(choose, "unit int, " + ", ".join(f"{f} binary" for f in Best._fields)).collect()}
    sent.destroy()
    out = []
    for unit in range(units):
        m = min(UNIT, len(level.subset) - unit * UNIT)
        if unit not in found:  # no tree has drawn a row of its nodes
            out.append(Best(np.zeros((m, level.classes)), np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, level.classes))))
            continue
        r = found[unit]
        out.append(Best(np.frombuffer(r["totals"]).reshape(m, -1), np.frombuffer(r["gain"]), np.frombuffer(r["feature"], np.int64),
                        np.frombuffer(r["bin"], np.int64), np.frombuffer(r["left"]).reshape(m, -1)))
    return out


# ------------------------------------------------------------------ trees

def tree_order(trees: Iterable[int]) -> list[int]:
    """The order in which a Scala map of these trees, filled from a mutable one, is gone through."""
    keys = sorted(set(trees))
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))

    def improved(k: int) -> int:
        h = (k + ~(k << 9)) & 0xFFFFFFFF
        h ^= h >> 14
        h = (h + (h << 4)) & 0xFFFFFFFF
        return h ^ (h >> 10)

    def walk(own: list[int], shift: int) -> list[int]:
        places: dict[int, list[int]] = {}
        for k in own:
            places.setdefault((improved(k) >> shift) & 31, []).append(k)
        alone = [places[p][0] for p in sorted(places) if len(places[p]) == 1]
        return alone + [k for p in sorted(places) if len(places[p]) > 1 for k in walk(places[p], shift + 5)]

    return walk(keys, 0)


class Tree(NamedTuple):
    """A grown node with what is below it."""
    counts: np.ndarray
    impurity: float
    gain: float
    feature: int
    threshold: float
    left: "Tree | None"
    right: "Tree | None"


class _Growing:
    """The nodes of all trees while they grow, by number."""

    def __init__(self, trees: int, classes: int):
        self.tree, self.level = list(range(trees)), [0] * trees
        self.left, self.feature, self.bin = list(range(trees)), [0] * trees, [0] * trees
        self.counts, self.gain, self.valid = [np.zeros(classes)] * trees, [0.0] * trees, [True] * trees

    def add(self, parent: int, counts: np.ndarray) -> int:
        for column, value in ((self.tree, self.tree[parent]), (self.level, self.level[parent] + 1), (self.left, len(self.left)), (self.feature, 0), (self.bin, 0),
                              (self.counts, counts), (self.gain, 0.0), (self.valid, True)):
            column.append(value)
        return len(self.left) - 1

    def tree_of(self, node: int, bins: Bins) -> Tree:
        """A node with its children; leaves of one prediction are joined."""
        counts, left = self.counts[node], self.left[node]
        impurity = float(gini(counts))
        if left == node:
            return Tree(counts, impurity if self.valid[node] else -1.0, -1.0, -1, 0.0, None, None)
        lower, upper = self.tree_of(left, bins), self.tree_of(left + 1, bins)
        if lower.left is None and upper.left is None and lower.counts.argmax() == upper.counts.argmax():
            return Tree(counts, impurity, -1.0, -1, 0.0, None, None)
        f = self.feature[node]
        return Tree(counts, impurity, self.gain[node], f, float(bins.value[bins.first[f] + self.bin[node]]), lower, upper)


class Subsets:
    """The features of the nodes in the order in which they are split: the same for all forests of one seed and width."""

    def __init__(self):
        self.known: dict[tuple[int, int, int], np.ndarray] = {}
        self.lock = threading.Lock()

    def get(self, spark: SparkSession, seed: int, features: int, each: int, upto: int) -> np.ndarray:
        """The subsets of the first ``upto`` nodes."""
        if each >= features:
            return np.broadcast_to(np.arange(features, dtype=np.int32), (upto, features))
        key = (seed, features, each)
        with self.lock:
            known = self.known.get(key, np.zeros((0, each), np.int32))
            seeds = list(islice(java_longs(seed), len(known), max(upto, len(known))))
            tasks = [seeds[at:at + NODE_LANES] for at in range(0, len(seeds), NODE_LANES)]
            if len(tasks) > 1:
                fresh = spark.sparkContext.parallelize(tasks, len(tasks)).map(lambda own: reservoirs(own, features, each).tobytes()).collect()
                known = np.concatenate([known, *(np.frombuffer(b, np.int32).reshape(-1, each) for b in fresh)])
            elif tasks:
                known = np.concatenate([known, reservoirs(seeds, features, each)])
            self.known[key] = known
        return known[:upto]


def grow(split: DataFrame, trees: int, depth: int, seed: int, max_bins: int, memory_mb: int, counts: Callable[[], Counts] | None = None,
         subsets: Subsets | None = None) -> tuple[list[Tree], Shape]:
    """The trees of a forest, from rows as ``_split`` gives them in the partitions and order that the draws follow."""
    spark, subsets = split.sparkSession, subsets or Subsets()
    shape = shape_of(split)
    bins = bins_of(split, shape, max_bins, seed)
    splits = np.diff(bins.first)
    shared = counts() if counts else None
    drawn = shared if shared and shared.cover(shape.rows, trees) else bootstrap_counts(spark, shape.rows, trees, seed)
    rows, path = save(binned(split, bins).join(drawn.table.hint("merge"), ["part", "block"]), "forest-rows")
    each = shape.features if trees == 1 else math.ceil(math.sqrt(shape.features))
    nodes, used = _Growing(trees, shape.classes), 0
    stack = list(range(trees))  # the last is split first
    while stack:
        drawn_now, room, group = subsets.get(spark, seed, shape.features, each, used + len(stack))[used:], memory_mb << 20, []
        sizes = 8 * shape.classes * (splits + 1)[drawn_now[:1] if each == shape.features else drawn_now].sum(axis=1)
        for size in np.broadcast_to(sizes, len(stack)).tolist():
            if each < shape.features:
                used += 1  # a node that finds no room has used up its draw too
            if group and size > room:
                break
            room -= size
            group.append(stack.pop())
        slot = np.full(len(nodes.left), -1, np.int64)
        slot[group] = np.arange(len(group))
        level = Level(np.arange(trees), np.array(nodes.left), np.array(nodes.feature), np.array(nodes.bin), slot, drawn_now[:len(group)].astype(np.int64),
                      bins.zero, bins.most, shape.classes, max(nodes.level[node] for node in group))
        found = split_nodes(rows, level, splits)
        by_tree: dict[int, list[int]] = {}
        for node in group:
            by_tree.setdefault(nodes.tree[node], []).append(node)
        for tree in tree_order(by_tree):
            for node in by_tree[tree]:
                unit, at = divmod(int(slot[node]), UNIT)
                best = found[unit]
                nodes.counts[node], nodes.valid[node] = best.totals[at], bool(np.isfinite(best.gain[at]))
                if best.gain[at] <= 0 or nodes.level[node] == depth:
                    continue
                nodes.gain[node], nodes.feature[node], nodes.bin[node] = float(best.gain[at]), int(best.feature[at]), int(best.bin[at])
                lower, upper = best.left[at], best.totals[at] - best.left[at]
                nodes.left[node] = nodes.add(node, lower)
                nodes.add(node, upper)
                for child, own in ((nodes.left[node], lower), (nodes.left[node] + 1, upper)):
                    if nodes.level[child] < depth and abs(float(gini(own))) >= EPSILON:
                        stack.append(child)
    release(spark, path)
    if drawn is not shared:
        release(spark, drawn.path)
    return [nodes.tree_of(root, bins) for root in range(trees)], shape


# ------------------------------------------------------------------ models

def _numbered(tree: Tree) -> list[tuple[Tree, int, int]]:
    """The nodes, each before those below it and the lower side first, with the numbers of their children."""
    out: list = []

    def walk(node: Tree) -> int:
        at = len(out)
        out.append(None)
        out[at] = (node, *((walk(node.left), walk(node.right)) if node.left else (-1, -1)))
        return at

    walk(tree)
    return out


class GrownForest(Model):
    """A grown forest: its nodes as arrays for ``forests``, and as a model of Spark's."""

    def __init__(self, trees: list[Tree], shape: Shape, settings: RandomForestClassifier):
        super().__init__()
        self.trees, self.shape, self.settings = trees, shape, settings

    def nodes(self) -> Forest:
        root, rows = [], []
        for own in map(_numbered, self.trees):
            first = len(rows)
            root.append(first)
            rows += [(low + first, high + first, node.feature, node.threshold, node.counts) if node.left else (-1, -1, -1, math.nan, node.counts) for node, low, high in own]
        left, right, feature, threshold, counts = zip(*rows)
        counts = np.array(counts, float)
        return Forest(np.array(root), np.array(left, np.int64), np.array(right, np.int64), np.array(feature, np.int64), np.array(threshold, float),
                      counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300))

    def model(self, spark: SparkSession) -> RandomForestClassificationModel:
        """Spark's own model of these trees, read from the form in which it saves them."""
        path = scratch_path(spark, "forest")
        kind = "org.apache.spark.ml.classification."
        common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        given, default = ({p.name: v for p, v in m.items()} for m in (self.settings._paramMap, self.settings._defaultParamMap))
        own = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain",
               "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "probabilityCol", "rawPredictionCol", "seed")
        whole = common | {"class": kind + "RandomForestClassificationModel", "uid": self.settings.uid, "paramMap": given, "defaultParamMap": default,
                          "numFeatures": self.shape.features, "numClasses": self.shape.classes, "numTrees": len(self.trees)}
        single = common | {"class": kind + "DecisionTreeClassificationModel", "paramMap": {k: v for k, v in given.items() if k in own},
                           "defaultParamMap": {k: v for k, v in default.items() if k in own}}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(i, json.dumps(single | {"uid": f"{self.settings.uid}_{i}"}), 1.0) for i in range(len(self.trees))], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        rows = [(i, (at, float(node.counts.argmax()), node.impurity, [float(c) for c in node.counts], int(node.counts.sum()), node.gain, low, high,
                     (node.feature, [node.threshold], -1) if node.left else (-1, [], -1)))
                for i, tree in enumerate(self.trees) for at, (node, low, high) in enumerate(_numbered(tree))]
        spark.createDataFrame(rows, "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
                                    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>").coalesce(1).write.parquet(f"{path}/data")
        model = RandomForestClassificationModel.load(path)
        release(spark, path)
        return model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model(dataset.sparkSession).transform(dataset)


class SparseForest(Estimator):
    """Grows the forest that ``settings`` would fit, from sparse rows.

    ``counts`` (to be called when they are needed) and ``subsets`` are draws that forests of the same seed share."""

    def __init__(self, settings: RandomForestClassifier, counts: Callable[[], Counts] | None = None, subsets: Subsets | None = None):
        super().__init__()
        fixed = {"featureSubsetStrategy": "auto", "impurity": "gini", "bootstrap": True, "subsamplingRate": 1.0, "minInstancesPerNode": 1, "minInfoGain": 0.0,
                 "minWeightFractionPerNode": 0.0}
        other = {name for name, value in fixed.items() if settings.getOrDefault(name) != value}
        if other or settings.isDefined("weightCol") or settings.isDefined("thresholds"):
            raise ValueError(f"only their usual values: {sorted(other) or 'weightCol, thresholds'}")
        self.settings, self.counts, self.subsets = settings, counts, subsets

    def _fit(self, dataset: DataFrame) -> GrownForest:
        s = self.settings
        trees, shape = grow(_split(dataset, s.getLabelCol(), s.getFeaturesCol()), s.getNumTrees(), s.getMaxDepth(), s.getSeed(), s.getMaxBins(), s.getMaxMemoryInMB(),
                            self.counts, self.subsets)
        return GrownForest(trees, shape, s.copy())
