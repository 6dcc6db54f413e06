"""Removal of repeated byte strings by suffix arrays.

The texts that can hold a repeat are dealt to shards (see ``repeats``); each
shard ranks all suffixes of its text by their first ``WINDOW`` bytes, by
prefix doubling:

* suffixes are sorted by as many bytes as fit into a number with their place,
* those that tie are sorted by their rank so far and the rank of what follows
  the bytes that are known to be equal; this doubles the known bytes,
* the last step overlaps the one before, so ranks stand for ``WINDOW`` bytes.

Suffixes that share a rank are the repeats.

A cluster-wide sort of every suffix would write at least 16 bytes for each
byte of text and level.  Dealing by anchors keeps all suffixes that could
be equal in one shard, so the shards need no merge among them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import ranges
from riverbend.llm.repeats import HOT, Bytes, Plan, Segments, remove_repeats

WINDOW, GRAM = 200, 32


def in_order(keys: np.ndarray, above: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys and the place of each; keys are below ``above``."""
    bits = len(keys).bit_length()
    if above << bits > 1 << 63:
        order = np.argsort(keys)
        return keys[order], order
    packed = np.sort(keys << bits | np.arange(len(keys)))  # several times as quick
    return packed >> bits, packed & (1 << bits) - 1


def suffix_ranks(letters: np.ndarray, depth: int) -> np.ndarray:
    """How many suffixes are smaller than the one at each place, by their first
    ``depth`` letters; suffixes equal so far share a rank.  Letters are positive."""
    n = len(letters)
    if not n:
        return np.empty(0, np.int64)
    t = np.cumsum(np.bincount(letters) > 0)[letters]  # the letters that occur, from 1 on
    base, known = int(t.max()) + 1, 1
    keys = t
    while known < depth and base ** (known + 1) << n.bit_length() <= 1 << 63:
        keys = keys * base
        keys[:max(0, n - known)] += t[known:]
        known += 1
    ranks, tied = np.empty(n, np.int64), np.arange(n)
    group = np.zeros(n, np.int64)  # of the tied places, their ranks so far
    above = base ** known
    while True:
        keys, order = in_order(keys, above)
        places, group = tied[order], group[order]
        starts = np.concatenate(([True], keys[1:] != keys[:-1]))
        heads = np.concatenate(([True], group[1:] != group[:-1]))
        at = np.arange(len(keys))
        group = group + np.maximum.accumulate(at * starts) - np.maximum.accumulate(at * heads)
        ranks[places] = group
        open_ = ~(starts & np.append(starts[1:], True))
        if known >= depth or not open_.any():
            return ranks
        # what follows the known letters; the last step overlaps them, so that none beyond ``depth`` counts
        step = min(known, depth - known)
        tied, group = places[open_], group[open_]
        after = np.append(ranks + 1, 0)[np.minimum(tied + step, n)]
        keys, above = group * (n + 1) + after, n * (n + 1)
        known += step


def resolve(plan: Plan):
    """How often each window occurs, over all documents and places."""

    def run(rows: Segments) -> np.ndarray:
        out = np.repeat(rows.count, rows.windows)
        # equal segments are one row by now; the only segment of its anchor has nothing to be compared with
        change = rows.shard[1:] != rows.shard[:-1]
        alone = np.concatenate(([True], change)) & np.concatenate((change, [True]))
        own = np.flatnonzero(~alone)
        if not len(own):
            return out
        texts, windows = [rows.texts[i] for i in own.tolist()], rows.windows[own]
        text = b"".join(texts)
        ranks = suffix_ranks(np.frombuffer(text, np.uint8).astype(np.int64) + 1, plan.window)
        lengths = np.array([len(x) for x in texts], np.int64)
        number = np.repeat(np.arange(len(texts)), windows)
        own_ranks = ranks[ranges(np.cumsum(lengths) - lengths, windows)]
        found = np.bincount(own_ranks, rows.count[own][number]).astype(np.int64)[own_ranks]
        out[np.repeat(~alone, rows.windows)] = found
        return out

    return run


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Removes each byte covered by a string of ``window`` bytes that also
    starts anywhere else, in the same document or another.  One row for each
    row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256.  A null text
    is empty; null ids and repeated rows are documents like any other."""
    plan = Plan(Bytes, window, gram)
    out = remove_repeats(docs, plan, resolve(plan), lambda times, doc: times > F.lit(1), id_col, text_col, hot)
    return out.withColumnRenamed("n_units", "n_bytes")
