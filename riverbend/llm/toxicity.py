"""Toxicity by the nearest labelled examples.

A text is a TF-IDF vector over the terms that go with the label; its nearest
examples by exact cosine vote, each with weight 1 / (distance + eps).

* Terms are words and word beginnings (``pref*``).  The ``TERMS`` of the
  largest G-squared statistic against the label in the fitted sample are kept,
  and all others that pass ``MIN_G2``.
* The inverse document frequencies are counted over all documents.
* A text of the same words as an example, whatever terms it has, has that
  example as its nearest, at the cosine 1.
* Examples with equal vectors are one entry with its votes, so ties by the
  thousand cost no more than one.  The entries lie in blocks of ``BLOCK``,
  sorted by their heaviest terms; for each term and block the index knows the
  largest weight.  A search visits the blocks in descending order of the
  score they could reach and stops where the k-th best cannot be beaten.
* Votes are calibrated by isotonic regression of the examples' labels on
  their own leave-one-out votes.

The examples are at most ``EXAMPLES`` rows, so the index is broadcast as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm.common import as_texts, fit_sample, held_out, plain_words, ranges, small_batches
from riverbend.session import release, save

#: Labelled rows that are learned from, at most.
EXAMPLES = 20_000
#: The fewest terms kept, of however small a sample, and what others must pass.
TERMS = 100
MIN_G2 = 30.0
PREFIXES = (4, 5, 6, 7)
NEIGHBOURS = 32
BLOCK = 64
EPS = 0.02
CACHED_WORDS = 300_000


def features(words: set[bytes]) -> set[bytes]:
    """The words and their beginnings, in whole UTF-8 characters."""
    out = set(words)
    for w in words:
        if w.isascii():
            out.update(w[:k] + b"*" for k in PREFIXES if len(w) > k)
        else:
            t = w.decode()
            out.update(t[:k].encode() + b"*" for k in PREFIXES if len(t) > k)
    return out


class Neighbours(NamedTuple):
    entry: np.ndarray
    cosine: np.ndarray


class BlockMaxIndex:
    """Inverted lists of unit vectors with the largest weight of each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        n = len(vectors)
        self.size, self.blocks = n, -(-n // BLOCK)
        entry = np.repeat(np.arange(n), [len(t) for t, _ in vectors]) if n else np.empty(0, np.int64)
        term = np.concatenate([t for t, _ in vectors]) if n else np.empty(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if n else np.empty(0)
        order = np.lexsort((entry, term))
        self.entry, self.weight, term = entry[order], weight[order], term[order]
        # lists of term t in block b: at[t, b] to at[t, b + 1]
        cell = term * self.blocks + self.entry // BLOCK
        self.at = np.searchsorted(cell, np.arange(n_terms)[:, None] * self.blocks + np.arange(self.blocks + 1))
        self.most = np.zeros((n_terms, self.blocks))
        np.maximum.at(self.most.reshape(-1), cell, self.weight)

    def _sums(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of ``blocks`` with a term in common, and their cosines."""
        lo = self.at[np.ix_(terms, blocks)].ravel()
        n = self.at[np.ix_(terms, blocks + 1)].ravel() - lo
        own = ranges(lo, n)
        sums = np.bincount(self.entry[own], np.repeat(np.repeat(weights, len(blocks)), n) * self.weight[own], self.size)
        hit = np.flatnonzero(sums)
        return hit, sums[hit]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> Neighbours:
        """The k entries of largest cosine above 0; ties to the smaller entry.
        Blocks are read a few at a time, best bound first, then twice as many."""
        entries, scores = np.empty(0, np.int64), np.empty(0)
        bound = weights @ self.most[terms]
        left, size = np.argsort(-bound, kind="stable"), 2
        left = left[bound[left] > 0]
        while len(left):
            hit, sums = self._sums(terms, weights, left[:size])
            entries, scores = np.append(entries, hit), np.append(scores, sums)
            best = np.lexsort((entries, -np.round(scores, 9)))[:k]
            entries, scores = entries[best], scores[best]
            left, size = left[size:], 2 * size
            if len(scores) == k:
                left = left[bound[left] >= scores[-1] - 1e-9]
        return Neighbours(entries, scores)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of a non-decreasing fit of y on x, at the distinct x (pool adjacent violators)."""
    x, group = np.unique(x, return_inverse=True)
    w = np.bincount(group, weight)
    m = np.bincount(group, weight * y) / w
    pools: list[list[float]] = []  # mean, weight, number of x
    for mean, own in zip(m.tolist(), w.tolist(), strict=True):
        pools.append([mean, own, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1] += b[1]
            a[2] += b[2]
    return x, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


Counts = tuple[tuple[int, int], ...]


class TermCounter:
    """Occurrences of the kept terms in a text."""

    def __init__(self, terms: list[bytes]):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: str) -> Counts:
        """(term, occurrences), in ascending order."""
        found: dict[int, int] = {}
        cache = self.cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        for w in plain_words(text):
            own = cache.get(w)
            if own is None:
                own = cache[w] = tuple(self.terms[f] for f in features({w}) if f in self.terms)
            for t in own:
                found[t] = found.get(t, 0) + 1
        return tuple(sorted(found.items()))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}


def whole(text: str) -> int:
    """What texts of the same words in the same order have in common; 0 without words."""
    words = plain_words(text)
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) if words else 0


class ToxicityModel:
    """Terms, weights, example index and calibration; of bounded size."""

    def __init__(self, terms: list[bytes], idf: np.ndarray, examples: list[tuple[int, int, Counts, int]]):
        """``examples``: (id, label, term counts, ``whole``); ``idf``: of each term."""
        self.counts = TermCounter(terms)
        self.idf = idf
        self.learned = len(examples)
        votes: dict[Counts, list] = {}
        self.copies: dict[int, list] = {}
        for doc, label, _, own in examples:
            if own:
                v = self.copies.setdefault(own, [0, 0, doc])
                v[0] += 1
                v[1] += label
                v[2] = min(v[2], doc)
        for doc, label, counts, _ in examples:
            v = votes.setdefault(counts, [0, 0, doc])
            v[0] += 1
            v[1] += label
            v[2] = min(v[2], doc)
        self.prior = (sum(v[1] for v in votes.values()) + 1) / (len(examples) + 2)
        none = votes.pop((), [0, 0, None])
        self.none = (none[1] + self.prior) / (none[0] + 1)
        vectors = {c: self.vector(c) for c in votes}
        heavy = {c: tuple(t[np.lexsort((t, -w))].tolist()) for c, (t, w) in vectors.items()}
        order = sorted(votes, key=lambda c: (heavy[c], c))
        self.n = np.array([votes[c][0] for c in order], float)
        self.positive = np.array([votes[c][1] for c in order], float)
        self.example = [votes[c][2] for c in order]
        self.index = BlockMaxIndex([vectors[c] for c in order], len(terms))
        self.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        raw, label, weight = [], [], []
        for i, c in enumerate(order):
            near = self.index.search(*vectors[c], NEIGHBOURS)
            for y, count in ((1, self.positive[i]), (0, self.n[i] - self.positive[i])):
                if count:
                    raw.append(self.vote(near, without=(i, y)))
                    label.append(y)
                    weight.append(count)
        if raw:
            self.steps = isotonic(np.array(raw), np.array(label, float), np.array(weight))
        self.known: dict[tuple[Counts, int | None], tuple] = {}

    def vector(self, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
        terms, n = np.array(counts, np.int64).T
        weights = (1 + np.log(n)) * self.idf[terms]
        return terms, weights / np.linalg.norm(weights)

    def vote(self, near: Neighbours, without: tuple[int, int] | None = None, copies: tuple[int, int] = (0, 0)) -> float:
        """Share of positive votes; ``without``: an entry and the label of one vote
        to leave out; ``copies``: votes, and positive ones, of examples that are the text itself."""
        n, positive = self.n[near.entry].copy(), self.positive[near.entry].copy()
        if without:
            own = near.entry == without[0]
            n[own] -= 1
            positive[own] -= without[1]
        w = 1 / (np.clip(1 - near.cosine, 0, 1) + EPS)
        return float((w @ positive + copies[1] / EPS + self.prior) / (w @ n + copies[0] / EPS + 1))

    def score(self, text: str) -> tuple[float, list[tuple[int, float, float]]]:
        """The calibrated score, and as evidence the nearest example of each of
        up to three entries: (id, cosine, share of positive votes)."""
        counts = self.counts(text)
        n, positive, doc = self.copies.get(whole(text), (0, 0, None))
        if not counts and not n:
            return self.none, []
        if (counts, doc) not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            near = self.index.search(*self.vector(counts), NEIGHBOURS) if counts else Neighbours(np.empty(0, np.int64), np.empty(0))
            raw = self.vote(near, copies=(n, positive))
            score = 0.98 * float(np.interp(raw, *self.steps)) + 0.02 * raw
            top = [(self.example[e], float(c), float(self.positive[e] / self.n[e])) for e, c in zip(near.entry[:3].tolist(), near.cosine[:3], strict=False)]
            if n:
                top = [(doc, 1.0, positive / n), *(t for t in top if t[0] != doc)][:3]
            self.known[counts, doc] = (min(1.0, max(0.0, score)), top)
        return self.known[counts, doc]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}


def _term_counts(sample: DataFrame) -> DataFrame:
    """Texts and positive texts with each term, of (label, text); copies of a text count once."""
    texts = sample.groupBy(F.xxhash64("text")).agg(F.max("label").alias("label"), F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            for label, text in zip(batch.column("label").to_pylist(), as_texts(batch.column("text")), strict=True):
                for f in features(set(plain_words(text))):
                    own = found.setdefault(f, [0, 0])
                    own[0] += 1
                    own[1] += label
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array([x for x, _ in found.values()], pa.int64()), pa.array([x for _, x in found.values()], pa.int64())],
                names=["term", "docs", "positive"])

    counted = texts.select("label", "text").mapInArrow(run, "term binary, docs long, positive long")
    return counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("positive").alias("positive"))


def g_squared(docs: Column, positive: Column, n: int, n_positive: int) -> Column:
    """G-squared of the two by two table of a term and the label."""
    out = F.lit(0.0)
    for seen, of in ((positive, n_positive), (docs - positive, n - n_positive)):
        for o, share in ((seen, docs), (F.lit(of) - seen, F.lit(n) - docs)):
            out = out + F.when(o > 0, 2 * o * F.log(o * float(n) / (share * float(of)))).otherwise(0.0)
    return out


def _document_frequencies(docs: DataFrame, text_col: str, terms: list[bytes]) -> tuple[int, np.ndarray]:
    """Number of documents, and those with each term, over all of ``docs``."""
    count = TermCounter(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            n += batch.num_rows
            for text in as_texts(batch.column(0)):
                seen[[t for t, _ in count(text)]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(terms))), pa.array(np.concatenate([[n], seen]))], names=["term", "n"])

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())  # one row for each kept term
    counts = dict((r.term, r.n) for r in rows)
    return counts.get(-1, 0), np.array([counts.get(t, 0) for t in range(len(terms))], float)


def _without_doubles(found: list) -> list[bytes]:
    """Of a word or beginning and a shorter beginning with the same counts, the longer."""
    found = sorted(found, key=lambda r: (-len(bytes(r.term)), bytes(r.term)))
    kept: dict[tuple[int, int], list[bytes]] = {}
    for r in found:
        term, same = bytes(r.term), kept.setdefault((r.docs, r.positive), [])
        if not (term.endswith(b"*") and any(t.startswith(term[:-1]) for t in same)):
            same.append(term)
    return sorted(t for same in kept.values() for t in same)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        examples: int = EXAMPLES, modulus: int = 5, remainder: int = 0) -> ToxicityModel:
    """Learns from labelled rows that are not held out.  Without any labelled
    row every score is one half."""
    small_batches(docs.sparkSession)
    sample, path = save(fit_sample(docs, labels, label_col, lambda c: ~held_out(c, modulus, remainder), examples, id_col, text_col), "toxicity-fit")
    n, positive = (sample.groupBy(F.xxhash64("text")).agg(F.max("label").alias("label"))
                   .agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first())
    counted, terms_path = save(_term_counts(sample).withColumn("g2", g_squared(F.col("docs"), F.col("positive"), n, positive)).where("g2 > 1e-9"), "toxicity-terms")
    strongest = counted.orderBy(F.desc("g2"), "term").limit(TERMS)  # ties by the term itself
    kept = counted.where(F.col("g2") >= MIN_G2).union(strongest).distinct()
    terms = _without_doubles(kept.collect()) if n else []
    total, seen = _document_frequencies(docs, text_col, terms)
    count = TermCounter(terms)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_texts(batch.column("text"))
            own = [count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([[t for t, _ in c] for c in own], pa.list_(pa.int64())),
                 pa.array([[n for _, n in c] for c in own], pa.list_(pa.int64())),
                 pa.array([whole(x) for x in texts], pa.int64())], names=["id", "label", "terms", "n", "whole"])

    found = sample.mapInArrow(counts, "id long, label int, terms array<long>, n array<long>, whole long").orderBy("id").collect()
    release(docs.sparkSession, path, terms_path)
    idf = np.log((total + 1) / (seen + 1)) + 1
    return ToxicityModel(terms, idf, [(r.id, r.label, tuple(zip(r.terms, r.n, strict=True)), r.whole) for r in found])


def score(text: Column, model: ToxicityModel) -> Column:
    """Score of each text, 0 to 1.  Null counts as empty: the share of positives
    among examples without any kept term."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)  # bounded by EXAMPLES

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.score(t)[0] for t in as_texts(texts)], pa.float64())

    return run(text)


def evidence(text: Column, model: ToxicityModel) -> Column:
    """The nearest examples of each text: (id, cosine, share of positive votes)."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64()), ("positive", pa.float64())]))

    @F.arrow_udf("array<struct<example: long, cosine: double, positive: double>>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([[{"example": e, "cosine": c, "positive": p} for e, c, p in sent.value.score(t)[1]] for t in as_texts(texts)], kind)

    return run(text)


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of ``op1_toxicity``: one row for each row of ``docs``."""
    model = fit(docs, labels)
    out = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``; all columns stay.
    Null and empty texts have no terms and stay.  Without any labelled row nothing is known to be toxic, and all rows stay."""
    model = fit(docs, labels)
    return docs.where(score(F.col("text"), model) < threshold) if model.learned else docs
