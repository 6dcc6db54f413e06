"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q and at least
``max(min_length, min_exponent * q)`` words, four periods or more, that no
neighbouring word extends keeping the period.

The scales are the powers of two.  At scale b the words are cut into blocks
of b words, and the sum of squared differences of a block's word numbers with
each of the b stretches that start b to 2 b - 1 words after it is computed by
one number-theoretic transform.  It is exact modulo a prime: a stretch without
a mismatch has the sum 0, and every sum of 0 is confirmed word by word.  The
distance d of two neighbouring blocks that both recur d words later seeds an
extension to the left and right, and the stretch so found is a run of period
d where it is long enough and d is its smallest period.  A run of period d in
[b, 2 b) has at least 3 d >= 3 b words that recur d words later, so two
neighbouring blocks lie among them: no run is missed.

Two exact tests keep blocks from the transform: a block one of whose words does
not recur in less than 2 b words, or without such a neighbour, recurs nowhere in
its window; and inside a run of a smaller period every recurrence is that
period's.  So a scale has few seeds, each extension is shorter than b words,
and n words take O(n log^2 n) steps, whatever the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_bytes, ranges, sliced

#: 15 * 2^27 + 1; ROOT generates its multiplicative group, so transforms have up to 2^27 cells.
PRIME, ROOT = 2013265921, 31
#: Cells of a transform's input held at once; one block's own transform may be larger.
CELLS = 1 << 19
FAR = np.int64(1) << 60

RUNS = "array<struct<start:long,length:long,period:long>>"
FOUND = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


@lru_cache(maxsize=64)
def _powers(n: int, inverse: bool) -> np.ndarray:
    """The first n / 2 powers of an n-th root of unity, or of its inverse."""
    root = pow(ROOT, (PRIME - 1) // n, PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out = np.ones(1, np.uint64)
    while 2 * len(out) < n:
        out = np.concatenate([out, _times(out, np.uint64(pow(root, len(out), PRIME)))])
    return out


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    product = x * y
    return product - product // np.uint64(PRIME) * np.uint64(PRIME)


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row, a power of two long; the inverse
    is n times too large.  Every level reads two halves and writes them interleaved."""
    (m, n), p = rows.shape, np.uint64(PRIME)
    each = 1
    while each < n:
        x, y = rows[:, :n // 2], rows[:, n // 2:]
        total, less = x + y, _times(x + p - y, np.repeat(_powers(n // each, inverse), each))
        rows = np.empty((m, n // 2 // each, 2, each), np.uint64)
        rows[:, :, 0] = np.minimum(total, total - p).reshape(m, -1, each)  # below zero wraps round
        rows[:, :, 1] = less.reshape(m, -1, each)
        rows = rows.reshape(m, n)
        each *= 2
    return rows


def mismatches(words: np.ndarray, squares: np.ndarray, at: np.ndarray, b: int) -> np.ndarray:
    """For each block of b words at ``at``, the sums modulo PRIME of its squared
    differences with the stretches that start b, ..., 2 b - 1 words later.
    ``squares`` sums the words' squares; ``words`` reaches 3 b words beyond."""
    block = np.zeros((len(at), 2 * b), np.uint64)
    block[:, :b] = words[at[:, None] + np.arange(b - 1, -1, -1)]
    window = words[at[:, None] + np.arange(b, 3 * b)].astype(np.uint64)
    share = np.uint64(pow(2 * b, PRIME - 2, PRIME))
    products = _times(transform(_times(transform(block), transform(window)), inverse=True)[:, b - 1:2 * b - 1], share).astype(np.int64)
    later = at[:, None] + np.arange(b, 2 * b)
    own = (squares[at + b] - squares[at])[:, None] + squares[later + b] - squares[later]
    return (own + 2 * (PRIME - products)) % PRIME


def _equal(words: np.ndarray, at: np.ndarray, d: np.ndarray, b: int, step: int) -> np.ndarray:
    """How many of the b words from ``at`` on, in direction ``step``, equal the word d later, before the first that does not."""
    out = np.empty(len(at), np.int64)
    each = max(1, CELLS // b)
    for k in range(0, len(at), each):
        place = at[k:k + each, None] + step * np.arange(b)
        same = (words[np.maximum(place, 0)] == words[place + d[k:k + each, None]]) & (place >= 0)
        out[k:k + each] = np.where(same.all(axis=1), b, same.argmin(axis=1))
    return out


def _prime_divisors(n: int) -> Iterator[int]:
    p = 2
    while p * p <= n:
        if n % p == 0:
            yield p
            while n % p == 0:
                n //= p
        p += 1
    if n > 1:
        yield n


def _primitive(word: np.ndarray) -> bool:
    """Whether the word is no power of a shorter one."""
    periods = (len(word) // p for p in _prime_divisors(len(word)))
    return not any((word[:-q] == word[q:]).all() for q in periods)


def _inside(found: Found, blocks: np.ndarray, b: int, n_blocks: int) -> np.ndarray:
    """For each block the end of the run with the least period that holds it whole, or 0."""
    start, end, period = found
    until = np.zeros(n_blocks, np.int64)
    order = np.argsort(-period, kind="stable")
    first, last = -(-start[order] // b), end[order] // b
    until[ranges(first, np.maximum(last - first, 0))] = np.repeat(end[order], np.maximum(last - first, 0))
    return until[blocks]


def find_runs(words: np.ndarray, longest: int, min_length: int = 6, min_exponent: int = 4) -> Found:
    """(start, end, period) of all runs of ``words``, numbers from 0 on, by start
    and period.  ``longest`` bounds the words of a run.  Numbers that occur once
    can separate documents, as no run holds one."""
    if min_exponent < 4:
        raise ValueError("blocks of the scales see all runs of four periods or more")
    n, unused = len(words), int(words.max(initial=0)) + 1
    gap = np.full(n, FAR)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    found: Found = (np.empty(0, np.int64),) * 3
    b = 1
    padded = np.concatenate([words, np.full(3 * max(longest, 1) + 3, unused, words.dtype)])
    squares = np.concatenate([[0], np.cumsum(padded.astype(np.int64) ** 2 % PRIME)])
    while min_exponent * b <= longest:
        alive = gap < 2 * b  # of each block, the largest distance to a word's next place
        beside = np.zeros(len(alive), bool)
        beside[:-1] |= alive[1:]
        beside[1:] |= alive[:-1]
        blocks = np.flatnonzero(alive & beside)
        until = _inside(found, blocks, b, len(alive))
        deep = until >= blocks * b + 3 * b
        blocks, until = blocks[~deep], until[~deep]
        at_parts, d_parts = [], []
        each = max(1, CELLS // (2 * b))
        for k in range(0, len(blocks), each):
            at = blocks[k:k + each] * b
            row, d = np.nonzero(mismatches(padded, squares, at, b) == 0)
            d += b
            new = at[row] + d + b > until[k:k + each][row]  # else a recurrence of the run round both
            at_parts.append(at[row[new]])
            d_parts.append(d[new])
        if at_parts:
            at, d, _ = _chains(np.concatenate(at_parts), np.concatenate(d_parts), b)
            sure = _equal(padded, at, d, b, 1) == b
            found = _extended(padded, at[sure], d[sure], b, found, min_length, min_exponent)
        gap = np.append(gap, np.full(len(gap) % 2, FAR))
        gap = np.maximum(gap[0::2], gap[1::2])
        b *= 2
    order = np.lexsort((found[2], found[0]))
    return found[0][order], found[1][order], found[2][order]


def _chains(at: np.ndarray, d: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks with a neighbour recurring at the same distance, in chains of neighbours, and where each chain starts."""
    order = np.lexsort((at, d))
    at, d = at[order], d[order]
    new = np.append(True, (np.diff(d) != 0) | (np.diff(at) != b))[:len(at)]
    chain = ~(new & np.append(new[1:], True)[:len(at)])
    return at[chain], d[chain], np.flatnonzero(new[chain])


def _extended(words: np.ndarray, at: np.ndarray, d: np.ndarray, b: int, found: Found, min_length: int, min_exponent: int) -> Found:
    """``found`` and the runs that hold neighbouring blocks recurring at one distance."""
    at, d, first = _chains(at, d, b)
    if not len(first):
        return found
    last = np.append(first[1:], len(at)) - 1
    d = d[first]
    before = _equal(words, at[first] - 1, d, b, -1)
    after = _equal(words, at[last] + b, d, b, 1)
    start, end = at[first] - before, at[last] + b + after + d
    # b equal words more are a block left out as inside a run, so that its period divides d
    long = (before < b) & (after < b) & (end - start >= np.maximum(min_length, min_exponent * d))
    start, end, d = start[long], end[long], d[long]
    own = np.fromiter((_primitive(words[s:s + q]) for s, q in zip(start.tolist(), d.tolist(), strict=True)), bool, len(d))
    return tuple(np.concatenate([a, x[own]]) for a, x in zip(found, (start, end, d), strict=True))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def runs_of_texts(texts: list[bytes], min_length: int = 6, min_exponent: int = 4) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Of each text, its number of words, its runs (start, length, period) and the words kept, joined by one space."""
    split = [text.split() for text in texts]
    numbers = _Numbers()
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    offsets = np.cumsum(lengths + 1) - lengths - 1
    words = np.empty(int(lengths.sum()) + len(split), np.int64)
    for own, at in zip(split, offsets.tolist(), strict=True):
        words[at:at + len(own)] = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
    words[offsets + lengths] = len(numbers) + np.arange(len(split))  # one number after each text
    start, end, period = find_runs(words, int(lengths.max(initial=0)), min_length, min_exponent)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.cumsum(gone) == 0
    first = np.searchsorted(start, offsets)
    last = np.searchsorted(start, offsets + lengths)
    for own, at, i, j in zip(split, offsets.tolist(), first.tolist(), last.tolist(), strict=True):
        if i == j:
            yield len(own), [], b" ".join(own)
            continue
        runs = list(zip((start[i:j] - at).tolist(), (end[i:j] - start[i:j]).tolist(), period[i:j].tolist(), strict=True))
        yield len(own), runs, b" ".join([own[k] for k in np.flatnonzero(kept[at:at + len(own)]).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """One row for each row of ``docs``: its id, its number of words
    ``[^\\x20\\x09-\\x0D]+``, its runs by start and period, and ``collapsed``, the
    words that are left when every run keeps its first period, joined by one space.

    A null, empty or blank text has no words and collapses to the empty text.
    Null and repeated ids and repeated rows each give their row; other columns
    are not carried.  The work is one pass of map tasks; a task holds some
    texts at a time, cut anywhere but inside a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = list(runs_of_texts(as_bytes(batch.column(1)), min_length, min_exponent))
            n, found, collapsed = zip(*rows, strict=True) if rows else [[]] * 3
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            found = [[{"start": s, "length": size, "period": q} for s, size, q in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FOUND)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period (the first of equal ones), null where there is none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def listing(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
