"""Helpers the operators share: tables on the shared folder, running totals of any group, hashed words of a batch."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findery.runtime import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The folders that ``stored`` wrote within ``scratch``.
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read back, so that no later step computes them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/findery-llm/{uuid.uuid4().hex}"
    if (paths := _written.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes at its end what ``stored`` wrote within; the function given stores tables that stay and may be read later."""
    paths: list[str] = []
    token = _written.set(paths)

    def kept(df: DataFrame) -> DataFrame:
        inner = _written.set(None)
        try:
            return stored(df)
        finally:
            _written.reset(inner)

    try:
        yield kept
    finally:
        _written.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(column: str) -> Column:
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def running(df: DataFrame, group: list[str], part: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the earlier rows of the group.

    ``part`` numbers bounded, consecutive parts of a group, so that a task holds one part, never a whole group; only one
    row per part meets in the window that adds up the parts. ``order`` sorts within a part.
    """
    parts = df.groupBy(*group, part).agg(F.sum(value).alias("_part_sum"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_part_sum").over(before), F.lit(0))).drop("_part_sum")
    within = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(parts, [*group, part])
        .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_base")
    )


# --- words of an Arrow batch as hashes, without a Python loop over words ---------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_OTHER = np.ones(256, dtype=bool)
_OTHER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A finishing mix of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base, dtype=np.uint64)]), dtype=np.uint64)[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of the words of all texts; words are maximal runs without a separator byte."""
    inside = np.empty(len(data) + 1, dtype=bool)
    inside[0] = False
    np.logical_not(separators[data], out=inside[1:])
    first = inside[1:] & ~inside[:-1]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begin] = inside[1:][begin]
    starts = np.flatnonzero(first)
    last = inside[1:].copy()
    last[:-1] &= ~inside[2:] | first[1:]
    ends = np.flatnonzero(last) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, owner


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the spans, mixed; equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * _powers(_INVERSE, len(data))[starts]
    return mixed(raw)


def words_of(texts: pa.Array, bare: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, bounds): the words of text i are ``bounds[i]:bounds[i + 1]``; A-Z folded.

    Words are split at ASCII white space, ``bare`` ones at all ASCII characters but letters and digits.
    """
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    starts, ends, owner = word_bounds(data, offsets, _OTHER if bare else _SPACE)
    return data, starts, ends, np.searchsorted(owner, np.arange(len(offsets)), side="left")


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the words between ASCII white space, in order."""
    data, starts, ends, bounds = words_of(texts)
    return span_hashes(data, starts, ends), bounds


def released() -> None:
    """Gives the memory that the worker's earlier tasks left unused back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that their texts stay near ``size`` bytes; a longer single text stays whole."""
    released()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
