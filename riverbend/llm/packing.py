"""Cost-balanced packing of token sequences.

A document of n tokens costs ``linear * n + quadratic * n * n`` (attention
stays inside a document).  Documents are cut into pieces of at most
``capacity`` tokens; the pieces are dealt to groups of bounded size, and in
each group assigned in descending order of cost to the sequence with the
lowest cost so far that still has room for the tokens.  A sequence is opened
where none has room.  Groups are drawn by a row counter kept with the saved
pieces, not by the id, so that repeated or null ids do not meet in one group.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_bytes, ranges, small_batches
from riverbend.session import save

#: Words whose ids a Python worker keeps; beyond it only the frequent ones stay.
KEPT_WORDS = 400_000
#: Sequences that one group fills, about.
GROUP_SEQUENCES = 1024
#: Cost of a token, and of a pair of tokens of one document: for a layer of width d, 24 d^2 and 4 d
#: operations; here d = 4096, in units of one token's linear part.
LINEAR, QUADRATIC = 1.0, 1 / (6 * 4096)

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_letters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: printable Latin-1
    stands for itself, the other bytes for U+0100 onwards in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return {b: chr(b if b in plain else next(other)) for b in range(256)}


class WordIds(dict):
    """Token ids of white-space separated words, each tokenised once.

    The tokenizer drops white space and never joins across it, so a text's
    ids are those of its words in order.  Of a word that is Latin letters and
    then marks, the two runs are what the tokenizer would split it into, so
    they go to its BPE model directly; any other word goes the whole way."""

    lines = re.compile(r"^(?:([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|.*)$", re.M)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.runs: dict[str, list[int]] = {}
        self.new: list[bytes] = []
        self.flat = np.empty(0, np.uint32)
        self.at = np.zeros(1, np.int64)
        self.seen = np.empty(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def _forget(self) -> None:
        """Keep the words met most often, a quarter of the table at most."""
        kept = np.sort(np.argsort(-self.seen, kind="stable")[: KEPT_WORDS // 4])
        words = list(self)
        self.clear()
        self.update(zip((words[i] for i in kept.tolist()), range(len(kept)), strict=True))
        lengths = np.diff(self.at)[kept]
        self.flat = self.flat[ranges(self.at[kept], lengths)]
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        self.seen = np.zeros(len(kept), np.int64)
        self.runs.clear()

    def _run(self, run: str) -> list[int]:
        mapped = run if run.isascii() else "".join(map(self.letters.__getitem__, run.encode()))
        self.runs[run] = ids = [t.id for t in self.model.tokenize(mapped)]
        return ids

    def _learn(self) -> None:
        """Ids of the words met for the first time."""
        found: list[list[int]] = []
        runs, run = self.runs.get, self._run
        for word, (letters, marks) in zip(self.new, self.lines.findall(b"\n".join(self.new).decode().lower()), strict=True):
            if letters:
                ids = runs(letters) or run(letters)
                found.append(ids + (runs(marks) or run(marks)) if marks else ids)
            else:
                found.append(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        self.new = []
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.seen = np.concatenate([self.seen, np.zeros(len(found), np.int64)])

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self) > KEPT_WORDS:
            self._forget()
        index = []
        for text in texts:
            words = text.split()
            index.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.new:
            self._learn()
        for i in index:
            np.add.at(self.seen, i, 1)
            yield self.flat[ranges(self.at[i], self.at[i + 1] - self.at[i])]


_word_ids: dict[str, WordIds] = {}


def _ids_of(path: str) -> WordIds:
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Each text's ids and ``end_id``, cut at multiples of ``capacity``.  A null
    or empty text is the end id alone; null ids and repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _ids_of(tokenizer_path)
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), words.encode(as_bytes(batch.column(1))), strict=True):
                ids = np.append(ids, end_id).astype("<u4")
                for start in range(0, len(ids), capacity):
                    own = ids[start:start + capacity]
                    rows.append((doc, start, len(own), zlib.crc32(own.tobytes()), len(ids), (part << 32) + n))
                    n += 1
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ``lengths`` in descending order, so the costs are too."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = max(1, -(-int(lengths.sum()) // capacity))
    cost, used = np.zeros(n), np.zeros(n, np.int64)
    opened = n
    for i, length in enumerate(lengths.tolist()):
        room = np.flatnonzero(used[:opened] <= capacity - length)
        if len(room):
            k = room[np.argmin(cost[room])]
        else:
            if opened == len(used):
                cost, used = np.concatenate([cost, np.zeros(n)]), np.concatenate([used, np.zeros(n, np.int64)])
            k, opened = opened, opened + 1
        sequence[i], offset[i] = k, used[k]
        cost[k] += linear * length + quadratic * length * length
        used[k] += length
    return sequence, offset


def pack(found: DataFrame, capacity: int = 4096, linear: float = LINEAR, quadratic: float = QUADRATIC,
         group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.  No piece exceeds ``capacity``."""
    tokens = found.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (capacity * group_sequences)))

    def fill(key: tuple[int], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "deal"], ascending=[False, True], ignore_index=True)
        sequence, rows["offset"] = assign(rows["length"].to_numpy(), capacity, linear, quadratic)
        rows["sequence_id"] = (key[0] << 32) + sequence
        return rows[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    # Int64 in pandas: ids can be null
    return (found.withColumn("_group", F.pmod(F.xxhash64("deal"), F.lit(groups)))
            .groupBy("_group").applyInPandas(lambda key, rows: fill(key, rows.drop(columns="_group").astype({"doc_id": "Int64"})), PACKED))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Tokenise and pack all rows of ``docs``: one row for each piece.  An empty
    table gives an empty result.  The saved pieces hold no texts or ids."""
    small_batches(docs.sparkSession)
    found, _ = save(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "pieces")
    return pack(found, capacity)
