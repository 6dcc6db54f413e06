"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_BATCH = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def small_batches(spark: SparkSession) -> None:
    """Ask for Arrow batches of few rows, as one row here is a whole document,
    where the session has no setting of its own.  Spark's byte limit per batch holds besides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(TEXT_BATCH))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = TEXT_BATCH) -> Iterator[pa.RecordBatch]:
    """The batches cut to a few rows each, as one row here is a whole document."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8; null gives the empty text."""
    return pc.fill_null(pc.cast(column, pa.binary()), b"").to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``key`` so that no key's rows are cut apart.
    Holds one batch and the rows of its last key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and keys[0] != held[-1].column(key)[held[-1].num_rows - 1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if keys[0] == keys[-1]:
            held.append(batch)
            continue
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def fit_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Callable[[str], Column], size: int,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, text) of at most ``size`` labelled documents where ``learn``
    of the id column holds, the first by a hash of the id.  Only labels 0 and 1 count; an id
    with both counts as 1; of repeated ids the least text is taken.  The
    chosen labels are ``size`` rows at most, so they are broadcast and no
    text is shuffled but the sample's."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1)))
    known = known.where(learn("id")).groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(size)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return own.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


_BLANKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    """Lower-cased words without ASCII marks; a mark ends a word."""
    return text.lower().encode().translate(_BLANKS).split()


def as_texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return pc.fill_null(column, "").to_pylist()
