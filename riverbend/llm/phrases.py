"""Removal of repeated passages by repeated phrases, located by winnowing.

A phrase is a run of ``PHRASE`` words that recurs; by winnowing, every
window of ``WINDOW`` words that occurs twice holds the same phrase at the
same place (see ``repeats``, whose hashes and bitmaps locate the phrases).
In a shard an Aho-Corasick automaton, with one letter for each word, numbers
the phrases exactly; it reads no more than each segment's own phrase.
From each occurrence the text is followed word by word to either side:
occurrences fall into classes of equal left and of equal right context of
every length, and two windows are equal if they have the phrase at the same
place and lie in the same class on both sides.  The least id of each class
of equal windows is what decides about the removal.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.repeats import HOT, Plan, Segments, Words, remove_repeats

WINDOW, PHRASE = 50, 12
#: Letters start behind the surrogates.
_FIRST_LETTER = 0x10000


def _classes(*keys: np.ndarray) -> np.ndarray:
    """A number for each distinct tuple."""
    out = keys[0]
    for k in keys[1:]:
        out = np.unique(out * (int(k.max(initial=0)) + 2) + k + 1, return_inverse=True)[1]
    return np.unique(out, return_inverse=True)[1]


def resolve(plan: Plan):
    """The least id among the documents that hold each window."""

    def run(rows: Segments) -> np.ndarray:
        codes: dict[bytes, int] = {}
        words = [[codes.setdefault(w, len(codes)) for w in t.split()] for t in rows.texts]
        texts = ["".join(chr(_FIRST_LETTER + c) for c in w) for w in words]
        automaton = ahocorasick.Automaton()
        phrases: dict[str, int] = {}
        for t, at in zip(texts, rows.at.tolist(), strict=True):
            automaton.add_word(p := t[at:at + plan.gram], phrases.setdefault(p, len(phrases)))
        automaton.make_automaton()
        # the phrase that chose a segment is the one located at its anchor
        phrase = np.full(len(texts), -1)
        for i, (t, at) in enumerate(zip(texts, rows.at.tolist(), strict=True)):
            for end, number in automaton.iter(t, at, at + plan.gram):
                if end == at + plan.gram - 1:
                    phrase[i] = number
        lengths = np.array([len(w) for w in words], np.int64)
        flat, begin = np.fromiter((c for w in words for c in w), np.int64, int(lengths.sum())), np.concatenate([[0], np.cumsum(lengths)[:-1]])

        def word(offset: int) -> np.ndarray:
            """The word at an offset from the phrase; -1 beyond the segment."""
            place = rows.at + offset
            inside = (place >= 0) & (place < lengths)
            return np.where(inside, flat[np.minimum(begin + np.maximum(place, 0), len(flat) - 1)], -1)

        before = [phrase]  # classes of equal context of d words before the phrase
        for d in range(1, int(rows.at.max()) + 1):
            before.append(_classes(before[-1], word(-d)))
        after = [phrase]  # and after it
        for d in range(int((lengths - rows.at).max()) - plan.gram):
            after.append(_classes(after[-1], word(plan.gram + d)))
        starts = np.concatenate([[0], np.cumsum(rows.windows)[:-1]])
        out = np.empty(int(rows.windows.sum()), np.int64)
        for place in range(plan.window - plan.gram + 1):  # of the phrase in the window
            window = rows.at - place
            own = np.flatnonzero((window >= 0) & (window < rows.windows))
            if len(own):
                group = _classes(before[place][own], after[plan.window - plan.gram - place][own])
                least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, group, rows.least[own])
                out[starts[own] + window[own]] = least[group]
        return out

    return run


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE, hot: int = HOT) -> DataFrame:
    """Removes each word covered by a window of ``window`` words whose words
    also start in a document with a smaller id.  One row for each row of
    ``docs``: id, n_words, n_removed, n_spans, kept_sha256 (of the kept words,
    joined by one space).  A null text has no words; a row with a null id has
    no place in the order, so it neither loses words nor takes any; rows with
    equal ids take nothing from one another."""
    plan = Plan(Words, window, phrase)
    out = remove_repeats(docs, plan, resolve(plan), lambda least, doc: least < doc, id_col, text_col, hot)
    return out.withColumnRenamed("n_units", "n_words")
