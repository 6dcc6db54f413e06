"""Shared plan of the two exact substring operators.

Both look for windows of a fixed number of units (words or bytes) that occur
more than once.  Emitting every window would multiply the corpus, so windows
are gathered by *anchors*: of the runs of ``gram`` units in a window, the one
with the least hash (winnowing).  Equal windows choose the same anchor at the
same place, so they can only meet under the same anchor.

1. One pass over the texts counts the anchors.  Those that recur are marked
   in a bitmap sized by their number (``CELLS``, ``MOST_BITS``), which goes to
   every task; a marked anchor may be single (then its windows are found to
   be), an unmarked one never recurs, and neither do its windows.
2. A second pass deals each marked anchor's *segment* (its windows' units) by
   the anchor to a shard.  Equal segments are merged before and after the
   shuffle.  An anchor with more than ``hot`` occurrences (a second bitmap) is
   dealt by single windows instead, so that nothing gathers in one task.
3. The operator decides in each shard, by its own method, which windows are
   equal, and gives each window of a segment a value.
4. The values go back to the documents, and the units they cover are removed.
   A third bitmap marks the texts that lose something, so that only those are
   shuffled.

A row is known by its id and the hash of its text.  Only the bitmaps pass
through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_bytes, ranges, small_batches, whole_groups
from riverbend.session import release, save

#: Occurrences of an anchor beyond which its windows are dealt one by one.
HOT = 8192
#: A bitmap has this many cells for each hash that it marks, but at most 2 ** MOST_BITS (16 MB).
CELLS, LEAST_BITS, MOST_BITS = 128, 16, 27
#: Units hashed at once, and bytes of segments that a shard task decides at once.
CHUNK, SHARD_BYTES = 1 << 18, 1 << 19
#: Units of short texts that are hashed side by side.
SIDE_BY_SIDE = 1 << 15

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier, and their inverses."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_MULTIPLIER, _INVERSE)):
            _powers[i] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scramble of 64-bit numbers."""
    out = x.copy()
    for _ in range(2):
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def range_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of units[start:end] for each pair; equal ranges have equal hashes."""
    power, inverse = _power(len(units) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(units * power[:-1])])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class Bytes:
    """Texts as bytes."""

    @staticmethod
    def split(text: bytes) -> np.ndarray:
        return np.frombuffer(text, np.uint8)

    @staticmethod
    def hashes(units: np.ndarray) -> np.ndarray:
        return _BYTE[units]

    @staticmethod
    def join(units: np.ndarray) -> bytes:
        return units.tobytes()


class Words:
    """Texts as words between ASCII white space, an object array of bytes."""

    @staticmethod
    def split(text: bytes) -> np.ndarray:
        words = text.split()
        out = np.empty(len(words), object)
        out[:] = words
        return out

    @staticmethod
    def hashes(units: np.ndarray) -> np.ndarray:
        words = units.tolist()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        return range_hashes(_BYTE[np.frombuffer(b"".join(words), np.uint8)], ends - lengths, ends)

    @staticmethod
    def join(units: np.ndarray) -> bytes:
        return b" ".join(units.tolist())


class Plan(NamedTuple):
    units: type[Bytes] | type[Words]
    window: int
    gram: int


class Anchors(NamedTuple):
    """Hash and place of each anchor, its first window and number of windows."""

    hash: np.ndarray
    at: np.ndarray
    first: np.ndarray
    windows: np.ndarray


def _least_grams(units: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams, and the place of the anchor of each window."""
    own = plan.units.hashes(units)
    power, inverse = _power(len(own) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(own * power[:-1])])
    grams = mix((sums[plan.gram:] - sums[:-plan.gram]) * inverse[:len(own) - plan.gram + 1])
    # least hash, then leftmost: the place is in the low bits; minima over doubling widths
    least = grams >> np.uint64(31) << np.uint64(31)
    least |= np.arange(len(grams), dtype=np.uint64)
    grams_in_window, width = plan.window - plan.gram + 1, 1
    while 2 * width <= grams_in_window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < grams_in_window:
        least = np.minimum(least[:width - grams_in_window], least[grams_in_window - width:])
    return grams, (least & np.uint64((1 << 31) - 1)).view(np.int64)


def anchors(units: np.ndarray, plan: Plan) -> Anchors:
    """The anchors of all windows of a text, in order."""
    found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]
    for base in range(0, len(units) - plan.window + 1, CHUNK):
        grams, at = _least_grams(units[base:base + CHUNK + plan.window - 1], plan)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        n = np.diff(np.append(first, len(at)))
        at = at[first]
        found.append((grams[at].view(np.int64), at + base, first + base, n))
    return Anchors(*map(np.concatenate, zip(*found, strict=True)))


def anchors_of(texts: list[np.ndarray], plan: Plan) -> Iterator[tuple[np.ndarray, Anchors]]:
    """The anchors of many texts: some of them with the number of the text of each.
    Short texts are hashed side by side, and the windows across their ends left out."""
    def together(numbers: list[int]) -> tuple[np.ndarray, Anchors]:
        if len(numbers) == 1:
            found = anchors(texts[numbers[0]], plan)
            return np.full(len(found.at), numbers[0]), found
        sizes = np.array([len(texts[k]) for k in numbers], np.int64)
        begin, n = np.cumsum(sizes) - sizes, sizes - plan.window + 1
        grams, at = _least_grams(np.concatenate([texts[k] for k in numbers]), plan)
        window, text = ranges(begin, n), np.repeat(np.arange(len(numbers)), n)
        at = at[window]
        first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
        at, of = at[first], text[first]
        return np.array(numbers)[of], Anchors(grams[at].view(np.int64), at - begin[of], window[first] - begin[of], np.diff(np.append(first, len(window))))

    held, size = [], 0
    for k, own in enumerate(texts):
        if len(own) < plan.window:
            continue
        if held and size + len(own) > SIDE_BY_SIDE:
            yield together(held)
            held, size = [], 0
        held.append(k)
        size += len(own)
    if held:
        yield together(held)


def _anchor_counts(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [own.hash for _, own in anchors_of([plan.units.split(t) for t in as_bytes(batch.column("text"))], plan)]
            own, times = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(times, pa.int64())], names=["anchor", "times"])

    return run


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes & (8 * len(bits) - 1)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def _bitmaps(texts: DataFrame, plan: Plan, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the anchors that recur, and of those with more than ``hot`` occurrences."""
    counts = texts.select("text").mapInArrow(_anchor_counts(plan), "anchor long, times long").groupBy("anchor").agg(F.sum("times").alias("times"))
    saved, path = save(counts.where("times > 1").select("anchor", (F.col("times") > hot).alias("hot")), "recurring")
    out = _bitmap(saved, "anchor"), _bitmap(saved.where("hot"), "anchor")
    release(texts.sparkSession, path)
    return out


def _bitmap(rows: DataFrame, col: str) -> np.ndarray:
    """Marks of a column of hashes of a saved table."""
    n_bits = min(max((CELLS * rows.count()).bit_length(), LEAST_BITS), MOST_BITS)
    cell = F.col(col).bitwiseAND(F.lit((1 << n_bits) - 1))
    # Spark's bitmaps have 4,096 bytes each, so at most 2 ** (MOST_BITS - 15) rows come back
    parts = rows.groupBy(F.shiftright(cell, 15).alias("part")).agg(F.bitmap_construct_agg(cell.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros(1 << (n_bits - 3), np.uint8)
    for p in parts:
        out[p.part << 12:(p.part + 1) << 12] = np.frombuffer(p.bits, np.uint8)
    return out


def _segments(texts: list[bytes], plan: Plan, recurring: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, int, bool, int, int, int, bytes, bytes]]:
    """(number of the text, anchor, whether it is hot, its place, first window, number of windows, segment and its id)
    of the texts' marked anchors."""
    split = [plan.units.split(t) for t in texts]
    for number, found in anchors_of(split, plan):
        kept = np.flatnonzero(_marked(recurring, found.hash))
        hot = _marked(many, found.hash[kept])
        for i, anchor, is_hot, at, first, windows in zip(*(x.tolist() for x in (number[kept], found.hash[kept], hot, found.at[kept], found.first[kept], found.windows[kept])), strict=True):
            segment = plan.units.join(split[i][first:first + windows + plan.window - 1])
            yield i, anchor, is_hot, at, first, windows, segment, xxhash.xxh3_128_digest(segment + windows.to_bytes(8))


def _segment_rows(plan: Plan, marks):
    """Segments for the shards; equal ones of a batch are one row."""
    kinds = {"shard": pa.int64(), "sid": pa.binary(), "skip": pa.int32(), "windows": pa.int32(), "at": pa.int32(), "segment": pa.binary(), "least": pa.int64(), "count": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recurring, many = marks.value
        for batch in batches:
            rows: dict[tuple[bytes, int], list] = {}
            docs = [NO_ID if doc is None else doc for doc in batch.column("doc_id").to_pylist()]
            for i, anchor, hot, at, first, windows, segment, sid in _segments(as_bytes(batch.column("text")), plan, recurring, many):
                doc = docs[i]
                if (known := rows.get((sid, -1))) or (known := rows.get((sid, 0))):
                    for j in range(known[3]) if known[3] else (0,):
                        own = rows[sid, j] if known[3] else known
                        own[6] = min(own[6], doc)
                        own[7] += 1
                    continue
                if not hot:
                    rows[sid, -1] = [anchor, sid, 0, 0, windows, segment, doc, 1, at - first]
                    continue
                units = plan.units.split(segment)
                for j in range(windows):
                    own = plan.units.join(units[j:j + plan.window])
                    rows[sid, j] = [xxhash.xxh64_intdigest(own) - (1 << 63), sid, j, windows, 1, own, doc, 1, at - first - j]
            columns = list(zip(*rows.values(), strict=True)) or [()] * 9
            shard, sid, skip, _, windows, segment, least, count, at = columns
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((shard, sid, skip, windows, at, segment, least, count), kinds.values(), strict=True)], names=list(kinds))

    return run


def _places(plan: Plan, marks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recurring, many = marks.value
        for batch in batches:
            rows = [(i, first, sid) for i, _, _, _, first, _, _, sid in _segments(as_bytes(batch.column("text")), plan, recurring, many)]
            i, first, sid = zip(*rows, strict=True) if rows else ((), (), ())
            own = pa.array(i, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(own), batch.column("th").take(own), pa.array(first, pa.int32()), pa.array(sid, pa.binary())],
                                             names=["doc_id", "th", "first", "sid"])

    return run


class Segments(NamedTuple):
    """Rows of a shard: equal segments are one, with its least id and number of occurrences."""

    shard: np.ndarray
    texts: list[bytes]
    windows: np.ndarray
    at: np.ndarray
    least: np.ndarray
    count: np.ndarray


NO_ID = np.iinfo(np.int64).max


def _decide(resolve: Callable[[Segments], np.ndarray]):
    """``resolve`` gives one value for each window of each segment, in order;
    runs of windows with one value become (from, n, value)."""

    def values(parts: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(parts).combine_chunks()
        windows = rows.column("windows").to_numpy().astype(np.int64)
        own = Segments(rows.column("shard").to_numpy(), rows.column("segment").to_pylist(), windows, rows.column("at").to_numpy().astype(np.int64),
                       rows.column("least").to_numpy(), rows.column("count").to_numpy())
        value = resolve(own)
        segment = np.repeat(np.arange(len(windows)), windows)
        begin = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (segment[1:] != segment[:-1]))))
        n = np.diff(np.append(begin, len(value)))
        first = begin - (np.cumsum(windows) - windows)[segment[begin]] + rows.column("skip").to_numpy()[segment[begin]]
        runs = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(value[begin], pa.int64())], names=["from", "n", "value"])
        at = np.concatenate([[0], np.cumsum(np.bincount(segment[begin], minlength=len(windows)))])
        return pa.RecordBatch.from_arrays([rows.column("sid").chunk(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs)], names=["sid", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in whole_groups(batches, "shard"):
            held.append(part)
            size += part.column("segment").nbytes
            if size >= SHARD_BYTES:
                yield values(held)
                held, size = [], 0
        if held:
            yield values(held)

    return run


def _removed(plan: Plan):
    names = ["doc_id", "n_units", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, runs = [], batch.column("runs")
            n_runs = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
            begin, n = (pc.struct_field(runs.flatten(), k).to_numpy(zero_copy_only=False) for k in ("from", "n"))
            begin, end = begin.astype(np.int64), begin.astype(np.int64) + n + plan.window - 1
            p = 0
            for text, own in zip(as_bytes(batch.column("text")), n_runs.tolist(), strict=True):
                units, q = plan.units.split(text), p + own
                change = np.bincount(begin[p:q], minlength=len(units) + 1) - np.bincount(end[p:q], minlength=len(units) + 1)
                gone = np.cumsum(change[:-1]) > 0
                p = q
                spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1]))))
                rows.append((len(units), int(np.count_nonzero(gone)), spans, hashlib.sha256(plan.units.join(units[~gone] if own else units)).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return run


def remove_repeats(docs: DataFrame, plan: Plan, resolve: Callable[[Segments], np.ndarray], goes: Callable[[Column, Column], Column],
                   id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_units, n_removed, n_spans and
    kept_sha256.  A window is removed where ``goes(value, doc_id)`` holds for
    the value that ``resolve`` gave it."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    marks = spark.sparkContext.broadcast(_bitmaps(texts, plan, hot))  # of bounded size
    keys = ["shard", "sid", "skip", "windows", "at", "segment"]
    segments = texts.select("doc_id", "text").mapInArrow(
        _segment_rows(plan, marks), "shard long, sid binary, skip int, windows int, at int, segment binary, least long, count long")
    segments = segments.repartition("shard").groupBy(*keys).agg(F.min("least").alias("least"), F.sum("count").alias("count"))
    values = (segments.sortWithinPartitions("shard", "sid", "skip")
              .mapInArrow(_decide(resolve), "sid binary, runs array<struct<from: int, n: int, value: long>>"))
    places = texts.mapInArrow(_places(plan, marks), "doc_id long, th long, first int, sid binary")
    # runs of rows with the same id and text are the same, and gathered once
    runs = F.transform(F.filter("runs", lambda r: goes(r["value"], F.col("doc_id"))), lambda r: F.struct((F.col("first") + r["from"]).alias("from"), r["n"].alias("n")))
    gone = places.join(values, "sid").select("doc_id", "th", runs.alias("runs")).where(F.size("runs") > 0)
    gone = gone.groupBy("doc_id", "th").agg(F.flatten(F.collect_set("runs")).alias("runs"))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "runs")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    # of the texts, only those that may lose something are shuffled
    gone, _ = save(gone, "gone")
    marks.destroy()
    losing = spark.sparkContext.broadcast(_bitmap(gone, "_th"))  # of bounded size

    @F.arrow_udf("boolean")
    def may_lose(th: pa.Array) -> pa.Array:
        return pa.array(_marked(losing.value, th.to_numpy(zero_copy_only=False)))

    changed = texts.where(may_lose("th")).join(gone, on, "left").select("doc_id", "text", "runs")
    same = texts.where(~may_lose("th")).select("doc_id", "text", F.lit(None).cast(gone.schema["runs"].dataType).alias("runs"))
    schema = "doc_id long, n_units long, n_removed long, n_spans long, kept_sha256 string"
    return (changed.mapInArrow(_removed(plan), schema).unionByName(same.mapInArrow(_removed(plan), schema))
            .withColumnRenamed("doc_id", id_col))
