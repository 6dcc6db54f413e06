"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are lower-cased and freed of ASCII marks.  Every run of ``n`` words of
a test item is a seed.  It is rare for the item if its document frequency
over the whole corpus is at most ``RARE`` times the item's lower quartile, or
below a small share of the corpus.  Where a document holds a seed, the stretch
round it is aligned with the item word by word; the best local alignment,
divided by the item's length, is the score: 1 for a whole copy, less for
edited, paraphrased or partial ones.

A frequent seed may owe its count to the leak itself (an edited copy in a
third of the corpus leaves only its own grams in the counts), so it is never
dropped: a stretch with frequent seeds only is aligned too, if some part of it
has as many of the item's words as the threshold asks for, which all leaks have.

An item of fewer than ``n`` words is its own seed, so any mention is a whole
copy.  Such an item is a leak only where it stands whole and is rare in the
corpus: in at most ``SHORT_DOCS`` documents or ``RARE_SHARE`` of them.  A more
frequent one, like a place name, tells nothing and matches no document.

The items go to the tasks as they are, in blocks of at most ``BLOCK_WORDS``
words; a larger benchmark takes one pass for each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm.common import as_texts, plain_words, small_batches

N = 3
RARE = 4
RARE_SHARE = 1 / 2000
SHORT_DOCS = 5
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
BLOCK_WORDS = 1_000_000


class Leak(NamedTuple):
    item: int
    score: float
    start: int
    end: int


def best_local(item: np.ndarray, words: np.ndarray) -> tuple[float, int]:
    """Score of the best local alignment and the end of it in ``words``.  A row
    of the Smith-Waterman table is one step; gaps along the row are a running
    maximum, as their cost is linear."""
    slope = -GAP * np.arange(len(words) + 1)
    above = np.zeros(len(words) + 1)
    best, end = 0.0, 0
    for w in item.tolist():
        row = np.zeros(len(words) + 1)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + np.where(words == w, MATCH, MISMATCH), above[1:] + GAP))
        row = np.maximum.accumulate(row + slope) - slope
        at = int(row.argmax())
        if row[at] > best + 1e-9:
            best, end = float(row[at]), at
        above = row
    return best, end


class Items:
    """A block of test items, their vocabulary and seeds."""

    def __init__(self, items: list[tuple[int, str]], n: int = N):
        self.words: dict[bytes, int] = {}
        self.items = [(i, np.array([self.words.setdefault(w, len(self.words)) for w in plain_words(t)], np.int64)) for i, t in items]
        self.bits = max(1, len(self.words).bit_length())
        if self.bits * n > 62:
            raise ValueError("a block of items has too many different words")
        self.n = n
        grams = defaultdict(list)  # gram -> (item number, place)
        for k, (_, ids) in enumerate(self.items):
            own = self.grams(ids, min(n, len(ids)))
            for place, g in enumerate(own.tolist()):
                grams[g].append((k, place))
        self.places = dict(grams)  # of the rare seeds; all of them, until the counts are known
        self.common: dict[int, list[tuple[int, int]]] = {}
        self.lengths = sorted({min(n, len(ids)) for _, ids in self.items if len(ids)})
        self.seeds = np.array(sorted(self.places), np.int64)

    def grams(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Key of each run of n known words; -1 where one is not in any item."""
        size = len(ids) - n + 1
        if n < 1 or size < 1:
            return np.empty(0, np.int64)
        key, known = np.full(size, n, np.int64) - 1, np.ones(size, bool)  # short items' runs have keys of their own
        key = key if n < self.n else np.zeros(size, np.int64)
        for j in range(n):
            part = ids[j:j + size]
            key = key << self.bits | part & ((1 << self.bits) - 1)
            known &= part >= 0
        if n < self.n:
            key = -2 - key
        return np.where(known, key, -1)

    def ids(self, text: str) -> np.ndarray:
        words = plain_words(text)
        get = self.words.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place in the text, gram) of every seed."""
        for n in self.lengths:
            own = self.grams(ids, n)
            known = np.flatnonzero(own != -1)
            if len(known) and len(self.seeds):
                at = np.minimum(np.searchsorted(self.seeds, own[known]), len(self.seeds) - 1)
                hit = known[self.seeds[at] == own[known]]
                yield from zip(hit.tolist(), own[hit].tolist(), strict=True)

    def keep_rare(self, counts: dict[int, int], n_docs: int) -> None:
        """Parts rare and frequent seeds by the document frequencies ``counts`` of the grams."""
        of_item = defaultdict(list)
        for g, places in self.places.items():
            for k, _ in places:
                of_item[k].append(counts.get(g, 0))
        limit = {k: max(RARE * float(np.quantile(x, 0.25)), 5, RARE_SHARE * n_docs) for k, x in of_item.items()}
        often = {k for k, x in of_item.items() if len(self.items[k][1]) < self.n and max(x) > max(SHORT_DOCS, RARE_SHARE * n_docs)}
        every = {g: rest for g, places in self.places.items() if (rest := [p for p in places if p[0] not in often])}
        self.places = {g: kept for g, places in every.items() if (kept := [p for p in places if counts.get(g, 0) <= limit[p[0]]])}
        self.common = {g: rest for g, places in every.items() if (rest := [p for p in places if counts.get(g, 0) > limit[p[0]]])}
        self.seeds = np.array(sorted({*self.places, *self.common}), np.int64)

    def leaks(self, text: str, threshold: float) -> list[Leak]:
        """The best alignment with each item that reaches ``threshold``."""
        ids = self.ids(text)
        spans, rare = defaultdict(list), set()
        for at, gram in self.hits(ids):
            own = self.places.get(gram, [])
            rare.update(k for k, _ in own)
            for k, place in own + self.common.get(gram, []):
                size = len(self.items[k][1])
                slack = size // 4 + 2
                spans[k].append((max(0, at - place - slack), min(len(ids), at - place + size + slack)))
        out = []
        for k, found in spans.items():
            item_id, item = self.items[k]
            known = np.zeros(len(self.words) + 1, bool)
            known[item] = True
            best = Leak(item_id, 0.0, 0, 0)
            for lo, hi in _merged(found):
                words = ids[lo:hi]
                # no alignment that reaches it is longer, as each word between costs a gap
                reach = len(words) if k in rare else min(len(words), int(len(item) * (1 + (threshold - 1) * MATCH / GAP)) + 1)
                seen = np.concatenate([[0], np.cumsum(known[words])])
                if (seen[reach:] - seen[:len(seen) - reach]).max() * MATCH < threshold * len(item):  # no alignment could reach it
                    continue
                score, end = best_local(item, words)
                if score / len(item) >= threshold and score / len(item) > best.score:
                    _, back = best_local(item[::-1], words[:end][::-1])
                    best = Leak(item_id, score / len(item), lo + end - back, lo + end)
            if best.score:
                out.append(best)
        return sorted(out, key=lambda x: (x.item is None, x.item, x.score))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _gram_counts(docs: DataFrame, items: Items, text_col: str) -> tuple[int, dict[int, int]]:
    """Number of documents, and those with each gram of the items, over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, defaultdict(int)
        for batch in batches:
            n += batch.num_rows
            for text in as_texts(batch.column(0)):
                for g in {g for _, g in items.hits(items.ids(text))}:
                    found[g] += 1
        yield pa.RecordBatch.from_arrays([pa.array([-1, *found]), pa.array([n, *found.values()])], names=["gram", "n"])

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())  # at most the grams of one block of items
    counts = {r.gram: r.n for r in rows}
    return counts.pop(-1, 0), counts


def item_blocks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """Blocks of items of about ``block_words`` words, with their rare seeds.
    Items without words cannot leak and are left out."""
    small_batches(docs.sparkSession)
    block, size = [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").orderBy("i", "t").toLocalIterator():
        n = len(plain_words(row.t))
        if block and size + n > block_words:
            yield _seeded(docs, block, text_col)
            block, size = [], 0
        if n:
            block.append((row.i, row.t))
            size += n
    if block:
        yield _seeded(docs, block, text_col)


def _seeded(docs: DataFrame, block: list[tuple[int, str]], text_col: str) -> Items:
    items = Items(block)
    n, counts = _gram_counts(docs, items, text_col)
    items.keep_rare(counts, n)
    return items


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each row of ``docs`` and item it holds: id, item_id, score,
    and the place in words (word_start, word_end).  Null and empty texts hold
    none; null ids stay; repeated rows give repeated results."""
    schema = "id long, item_id long, score double, word_start int, word_end int"
    out = docs.sparkSession.createDataFrame([], schema)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    for items in item_blocks(docs, benchmark, text_col=text_col, block_words=block_words):
        sent = docs.sparkSession.sparkContext.broadcast(items)  # bounded by block_words

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, *leak) for i, t in zip(batch.column("id").to_pylist(), as_texts(batch.column("text")), strict=True) for leak in sent.value.leaks(t, threshold)]
                yield pa.RecordBatch.from_pylist([dict(zip(_LEAKS.names, r, strict=True)) for r in rows], schema=_LEAKS)

        out = out.unionByName(source.mapInArrow(run, schema))
    return out.withColumnRenamed("id", id_col)


_LEAKS = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("word_start", pa.int32()), ("word_end", pa.int32())])


def holds(text: Column, items: Items, threshold: float = THRESHOLD) -> Column:
    """Whether a text holds any of the items."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(items)  # bounded by block_words

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([bool(sent.value.leaks(t, threshold)) for t in as_texts(texts)], pa.bool_())

    return run(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns stay."""
    out = docs
    for items in item_blocks(docs, benchmark, text_col=text_col):
        out = out.where(~holds(F.col(f"`{text_col}`"), items, threshold))
    return out
