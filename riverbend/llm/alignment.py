"""Alignment of two tokenizers' ids, over whole documents.

A text is tokenised whole by both: byte-level BPE (A) over a space and the
text, pieces (B) over the text, to which they add that space.  Where the bytes
of both give the text back, the byte offsets at which an A and a B token both
end cut the tokens into groups.  Shared ends before tokens that both mark with
a leading space are anchors: they cut a document into windows of ids, mostly
words.  The groups and links of a window depend on its ids alone, so they are
found once for each pair of id tuples and kept, with the bytes that the ids
spell; a document's windows, one after another, must spell its text.

Neither tokenizer joins what a single space parts: A's pattern begins a match
at such a space and B has no piece with a space after another letter.  So in
a text of words of plain characters with one space between any two, the ids of
a word are the same whatever stands around it, and each word is a window.  Such
words are tokenised once, many side by side in one text; all other texts are tokenised whole.

Two tokens that end at one offset have the same bytes as far as the shorter
one reaches: one is a suffix of the other.  The vocabularies have a fixed
number of such id pairs, some hundred thousand, whatever the corpus, so the
pairs are numbered, and the table of their counts is small enough for every
task.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_texts, ranges, sliced
from riverbend.llm.packing import _byte_letters
from riverbend.session import save

#: Windows that a Python worker keeps; beyond it only the frequent ones stay.
KEPT_WINDOWS = 200_000
#: Ids in all windows that it keeps.
KEPT_IDS = 4_000_000
#: Characters of white space in a row that the regular expression of the quick tokenizer is given.
MOST_BLANKS = 256
#: Words that are tokenised side by side when they are met for the first time.
WORDS_AT_ONCE = 256
#: Marks the ids of B in a window.
OF_B = 1 << 24
#: Not printable ASCII, a line end or a Latin letter of one code point, which no rule of B's normaliser joins to what follows.
ODD = re.compile("[^\n !-~\u00c0-\u024f]")
BLANKS = re.compile(r"\s{%d}" % MOST_BLANKS)

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>"


class Vocabularies(NamedTuple):
    """Files of the tokenizers: A's in the forms of two libraries, and B's."""
    byte_json: str
    byte_ranks: str
    pattern: str
    pieces: str


class Tokenizers:
    """Both tokenizers, with the bytes of each id."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(files.byte_ranks, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(files.byte_json)
        self.slow.encode_special_tokens = True
        letters = {letter: byte for byte, letter in _byte_letters().items()}
        self.a_bytes = [b""] * self.slow.get_vocab_size()
        for entry, i in self.slow.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(map(letters.__getitem__, entry))
        self.same = all(self.a_bytes[i] == word for word, i in ranks.items())
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.by_word = not any(b" " in word.lstrip(b" ") for word in self.b_bytes)

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def a(self, texts: list[str]) -> list[list[int]]:
        """A's ids of a space and each text.  The ranks are the same vocabulary and
        several times as quick; its regular expression can't take very long white space."""
        return [self.quick.encode_ordinary(" " + t) if self.same and not BLANKS.search(t)
                else self.slow.encode(" " + t, add_special_tokens=False).ids for t in texts]

    def b(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


def id_pairs(a_bytes: Sequence[bytes], b_bytes: Sequence[bytes]) -> np.ndarray:
    """All (a, b), as a << 32 | b in ascending order, of which one id's bytes end
    the other's: at most one for each suffix of a token and token of those bytes."""
    def ending(words: Sequence[bytes], of: Sequence[bytes]) -> Iterator[tuple[int, int]]:
        ids: dict[bytes, list[int]] = {}
        for i, word in enumerate(words):
            if word:
                ids.setdefault(word, []).append(i)
        for j, word in enumerate(of):
            for k in range(len(word)):
                for i in ids.get(word[k:], ()):
                    yield i, j
    pairs = {a << 32 | b for a, b in ending(a_bytes, b_bytes)} | {a << 32 | b for b, a in ending(b_bytes, a_bytes)}
    return np.array(sorted(pairs), np.int64)


class Numbers(dict):
    """Numbers of words, or of windows by their ids: those of A, then those of B with the bit ``OF_B``, as bytes of int32."""

    def __init__(self) -> None:
        self.new: list = []

    def __missing__(self, key: bytes | str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


def _words(text: str) -> list[str]:
    """The words of a text of plain characters with a single space and no line end between any two; none for other texts."""
    odd = not text or ODD.search(text) or "  " in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
    return [] if odd else text.split(" ")


def _joined(words: pa.Array, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words of the ids, one after another, and where each begins (and the last ends)."""
    taken = words.take(pa.array(ids))
    bounds = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1)
    return taken.buffers()[2].to_pybytes() if bounds[-1] else b"", bounds


def _cut(whole: bytes | str, bounds: np.ndarray) -> list:
    """``whole`` cut at the bounds."""
    at = bounds.tolist()
    return [whole[p:q] for p, q in zip(at[:-1], at[1:], strict=True)]


def _flat(lists: list[list[int]]) -> np.ndarray:
    """The ids of all lists, one after another."""
    return np.concatenate([np.empty(0, np.int32), *(np.array(own, np.int32) for own in lists)])


class Aligner:
    """Groups and links of texts, with a memory of windows."""

    def __init__(self, files: Vocabularies):
        self.tokenizers = t = Tokenizers(files)
        self.pairs = id_pairs(t.a_bytes, t.b_bytes)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, words)), np.int64) for words in (t.a_bytes, t.b_bytes))
        self.a_marked, self.b_marked = (np.array([w[:1] == b" " for w in words]) for words in (t.a_bytes, t.b_bytes))
        # an id with what follows it in the groups
        self.texts = pa.array([f"{i}{mark}" for words, marks in ((t.a_bytes, ",|"), (t.b_bytes, [",", ";", ""])) for mark in marks for i in range(len(words))], pa.large_string())
        self.a_words, self.b_words = (pa.array(words, pa.large_binary()) for words in (t.a_bytes, t.b_bytes))
        self._clear()

    def _clear(self) -> None:
        self.numbers = Numbers()
        self.words = Numbers()
        self.window_of = np.empty(0, np.int64)  # of each word; -1 where it is not one
        self.tokens = np.empty((2, 0), np.int64)  # of each window its A and B ids
        self.groups: list[str] = []
        self.bytes: list[bytes] = []  # what a window's ids spell; b"" where those of A and of B differ
        self.links, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int64)
        self.seen = np.zeros(0, np.int64)
        self.ids = 0

    def _forget(self) -> None:
        """Keep the windows met most often, a quarter of what is kept at most."""
        keys = list(self.numbers)
        order = np.argsort(-self.seen, kind="stable")
        sizes = np.array([len(key) // 4 for key in keys], np.int64)
        fits = np.cumsum(sizes[order]) <= KEPT_IDS // 4
        at = order[:KEPT_WINDOWS // 4][fits[:KEPT_WINDOWS // 4]]
        kept, groups, spelt, links, bounds, tokens = at.tolist(), self.groups, self.bytes, self.links, self.bounds, self.tokens
        renumbered = np.full(len(keys) + 1, -1)  # the last for words that are no window
        renumbered[at] = np.arange(len(at))
        words, window_of = list(self.words), renumbered[self.window_of]
        self._clear()
        known = np.flatnonzero(window_of >= 0)
        self.words.update(zip(map(words.__getitem__, known.tolist()), range(len(known)), strict=True))
        self.window_of, self.tokens = window_of[known], tokens[:, at]
        self.numbers.update(zip(map(keys.__getitem__, kept), range(len(kept)), strict=True))
        self.groups, self.bytes = list(map(groups.__getitem__, kept)), list(map(spelt.__getitem__, kept))
        n = bounds[at + 1] - bounds[at]
        self.links, self.bounds = links[ranges(bounds[at], n)], np.append(0, np.cumsum(n))
        self.seen = np.zeros(len(kept), np.int64)
        self.ids = int(sizes[at].sum())

    def _learn(self) -> None:
        """Align the windows met for the first time, side by side: each has as many bytes of A as of B."""
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        ids = np.frombuffer(b"".join(new), np.int32)
        of_b = ids >= OF_B
        sizes = np.fromiter(map(len, new), np.int64, len(new)) // 4
        window = np.repeat(np.arange(len(new)), sizes)
        a, b = ids[~of_b], ids[of_b] - OF_B
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        place = np.searchsorted(b_ends, a_ends)
        i = np.flatnonzero(b_ends[place] == a_ends)  # of each group its last A and B
        j = place[i]
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[i], b_last[j] = 1, 1
        b_last[np.flatnonzero(np.diff(window[of_b], append=len(new)))] = 2
        at = np.empty(len(ids), np.int64)  # the tokens' order in the groups
        before = np.append(0, j + 1)[np.cumsum(a_last) - a_last]
        at[np.arange(len(a)) + before] = a + a_last * len(self.a_sizes)
        upto = (i + 1)[np.cumsum(b_last > 0) - (b_last > 0)]
        at[np.arange(len(b)) + upto] = b + b_last * len(self.b_sizes) + 2 * len(self.a_sizes)
        texts, begin = _joined(self.texts, at)
        self.groups.extend(_cut(texts.decode(), begin[np.append(0, np.cumsum(sizes))]))
        spelt = []
        for words, own, mine in ((self.a_words, a, ~of_b), (self.b_words, b, of_b)):
            whole, begin = _joined(words, own)
            spelt.append(_cut(whole, begin[np.append(0, np.cumsum(np.bincount(window[mine], minlength=len(new))))]))
        self.bytes.extend([x if x == y else b"" for x, y in zip(*spelt, strict=True)])
        links = np.searchsorted(self.pairs, a[i].astype(np.int64) << 32 | b[j])
        self.links = np.concatenate([self.links, links.astype(np.int32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.bincount(window[~of_b][i], minlength=len(new)))])
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])
        self.tokens = np.concatenate([self.tokens, [np.bincount(window[own], minlength=len(new)) for own in (~of_b, of_b)]], axis=1)
        self.ids += len(ids)

    def _windows(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, last: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The windows of texts side by side, by their numbers, and which of them end a
        text.  ``last`` are the texts' last A ids; a text has as many bytes of A as of B."""
        # the A ids before a marked one or a text's end; a B id must end there as well, and a marked one follow
        ends = np.zeros(len(a), bool)
        ends[last] = True
        before = np.flatnonzero(np.append(self.a_marked[a[1:]], True) | ends)
        place = np.searchsorted(b_ends, a_ends[before])
        marked = np.append(self.b_marked[b[1:]], True)[place]
        anchor = (b_ends[place] == a_ends[before]) & marked | ends[before]
        i, j = before[anchor] + 1, place[anchor] + 1
        ids = np.empty(len(a) + len(b), np.int32)
        n_a, n_b = np.diff(i, prepend=0), np.diff(j, prepend=0)
        ids[ranges(i - n_a + j - n_b, n_a)] = a
        ids[ranges(i + j - n_b, n_b)] = b + OF_B
        raw, cuts, numbers = ids.tobytes(), (4 * (i + j)).tolist(), self.numbers
        return list(map(numbers.__getitem__, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts)))), np.flatnonzero(ends[before[anchor]])

    def _whole(self, texts: list[str]) -> list[list[int]]:
        """The windows of texts that are tokenised whole, by their numbers; none where the ids' bytes don't give a text back."""
        if not texts:
            return []
        a_ids, b_ids = self.tokenizers.a(texts), self.tokenizers.b(texts)
        whole = [b" " + text.encode() for text in texts]
        a, b = (_flat(ids) for ids in (a_ids, b_ids))
        a_ends, b_ends = np.append(0, np.cumsum(self.a_sizes[a])), np.append(0, np.cumsum(self.b_sizes[b]))
        a_upto, b_upto = (np.cumsum([0, *map(len, ids)]) for ids in (a_ids, b_ids))
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        fit = (sizes > 1) & (np.diff(a_ends[a_upto]) == sizes) & (np.diff(b_ends[b_upto]) == sizes)
        fits = np.flatnonzero(fit).tolist()
        out: list[list[int]] = [[] for _ in texts]
        if fits:
            if len(fits) < len(texts):
                a, b = (ids[np.repeat(fit, np.diff(upto))] for ids, upto in ((a, a_upto), (b, b_upto)))
                a_ends, b_ends = np.append(0, np.cumsum(self.a_sizes[a])), np.append(0, np.cumsum(self.b_sizes[b]))
            last = np.cumsum(np.diff(a_upto)[fit]) - 1
            windows, ends = self._windows(a, b, a_ends[1:], b_ends[1:], last)
            self._learn()
            p = 0
            for k, q in zip(fits, (ends + 1).tolist(), strict=True):
                if b"".join(map(self.bytes.__getitem__, windows[p:q])) == whole[k]:
                    out[k] = windows[p:q]
                p = q
        return out

    def _learn_words(self) -> None:
        """The windows of the words met for the first time."""
        new, self.words.new = self.words.new, []
        chunks = [new[k:k + WORDS_AT_ONCE] for k in range(0, len(new), WORDS_AT_ONCE)]
        found: list[int] = []
        for chunk, own in zip(chunks, self._whole([" ".join(chunk) for chunk in chunks]), strict=True):
            if [self.bytes[w] for w in own] != [b" " + word.encode() for word in chunk]:
                own = [alone[0] if len(alone) == 1 else -1 for alone in self._whole(chunk)]
                self.ids += sum(map(len, chunk))
            found += own
        self.window_of = np.concatenate([self.window_of, np.array(found, np.int64)])

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, str, np.ndarray]]:
        """Of each text the numbers of A ids and B ids, the groups, and the links' id pairs by their numbers."""
        if max(len(self.groups), len(self.words)) > KEPT_WINDOWS or self.ids > KEPT_IDS:
            self._forget()
        own = [list(map(self.words.__getitem__, _words(text) if self.tokenizers.by_word else ())) for text in texts]
        self._learn_words()
        windows = [self.window_of[np.array(words, np.int64)] for words in own]
        rest = [k for k, at in enumerate(windows) if not len(at) or at.min() < 0]
        for k, at in zip(rest, self._whole([texts[k] for k in rest]), strict=True):
            windows[k] = np.array(at, np.int64)
        self.seen += np.bincount(np.concatenate([np.empty(0, np.int64), *windows]), minlength=len(self.seen))
        for at in windows:
            links = self.links[ranges(self.bounds[at], self.bounds[at + 1] - self.bounds[at])]
            n_a, n_b = self.tokens[:, at].sum(axis=1).tolist()
            yield n_a, n_b, ";".join(map(self.groups.__getitem__, at.tolist())), links


@lru_cache(maxsize=2)
def _aligner(files: Vocabularies) -> Aligner:
    return Aligner(files)


def alignments(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the numbers of its A ids, B ids, groups
    and links, its ``groups`` as ``a1,a2|b1;a3|b2,b3``, and the numbers of its
    linked id pairs (``id_pairs``) with how many of its links are of each.

    A null or empty text, and one that the ids' bytes don't give back (as where
    B normalises it), has no tokens: zeros and empty values.  Null and
    repeated ids and repeated rows each give their row; other columns are not
    carried.  Map tasks only; a task holds some texts and a bounded memory of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        for batch in sliced(batches):
            rows = list(aligner.align(as_texts(batch.column(1))))
            n_a, n_b, groups, links = zip(*rows, strict=True) if rows else [[]] * 4
            pairs, times = zip(*(np.unique(own, return_counts=True) for own in links), strict=True) if rows else [[]] * 2
            bounds = np.append(0, np.cumsum([len(own) for own in pairs])).astype(np.int32)
            flat = [pa.array(np.concatenate([np.empty(0, np.int32), *own]).astype(np.int32)) for own in (pairs, times)]
            n_links = [len(own) for own in links]  # a group ends with one A and one B id
            counts = [pa.array(c, pa.int64()) for c in (n_a, n_b, n_links, n_links)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(groups, pa.string()), *(pa.ListArray.from_arrays(pa.array(bounds), own) for own in flat)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents are of each id pair."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("own"))
    return each.groupBy(F.col("own.pairs").alias("pair")).agg(F.sum("own.times").alias("n"))


def with_link_counts(aligned: DataFrame, counts: DataFrame, files: Vocabularies) -> DataFrame:
    """``aligned`` and, of each row, ``n_best``, its links whose pair has the
    highest count of all pairs with the same B id, and ``count_sum``, the sum of
    its links' counts.  ``counts`` has a row for each linked id pair at most, a
    number that the vocabularies bound."""
    spark = aligned.sparkSession
    tokenizers = Tokenizers(files)
    numbered = id_pairs(tokenizers.a_bytes, tokenizers.b_bytes)
    found = counts.toPandas()
    n = np.zeros(len(numbered), np.int64)
    n[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    b = numbered & 0xFFFFFFFF
    highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b, n)
    sent = spark.sparkContext.broadcast((n, n == highest[b]))

    @F.arrow_udf("n_best long, count_sum long")
    def scored(pairs: pa.Array, times: pa.Array) -> pa.Array:
        n, best = sent.value
        own, each = pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.list_value_length(pairs).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        out = np.zeros((2, len(sizes)), np.int64)
        np.add.at(out[0], row, each * best[own])
        np.add.at(out[1], row, each * n[own])
        return pa.StructArray.from_arrays([pa.array(out[0]), pa.array(out[1])], names=["n_best", "count_sum"])

    return aligned.withColumn("_scored", scored("pairs", "times")).select("*", "_scored.n_best", "_scored.count_sum").drop("_scored")


def alignment_table(docs: DataFrame, files: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The numbers of ids, groups and links of each row of ``docs``, its
    ``n_best`` and ``count_sum``, and the SHA-256 of its groups (empty where it has no tokens).  Texts are read
    once: the saved rows hold pair numbers and digests."""
    own = alignments(docs, files, id_col, text_col)
    own = own.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    saved, _ = save(own, "alignments")
    return with_link_counts(saved, pair_counts(saved), files).drop("pairs", "times")
