"""Texts as byte blocks, hashed words, and packed keys that meet in buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 3 << 20
"""Texts worked on together; a longer text is a block of its own."""

CHUNK_BYTES = 1 << 19
MIN_BUCKETS = 512
BLOCK_ROWS = 60_000

_random = np.random.default_rng(20260101)
_BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_CODES = _random.integers(1, 1 << 63, (2, 512), dtype=np.uint64) | np.uint64(1)

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of a row as one struct, so that own columns never clash with given ones."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without])


def bucket_count(df: DataFrame) -> int:
    """Buckets for keys of ``df``: in proportion to its input partitions, so that a bucket keeps its size."""
    return int(min(1 << 20, max(MIN_BUCKETS, 16 * df.rdd.getNumPartitions())))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (in place for the caller's own arrays)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in blocks of ``max_bytes`` of a binary column: the rows, their bytes, and the offsets of each row's bytes."""
    for batch in batches:
        array = batch.column(batch.schema.get_field_index(column))
        buffers = array.buffers()
        if not len(array):
            continue
        width = np.int64 if pa.types.is_large_binary(array.type) else np.int32
        offsets = np.frombuffer(buffers[1], dtype=width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(array):
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), len(array), start + BLOCK_ROWS)
            own = offsets[start : end + 1] - offsets[start]
            yield batch.slice(start, end - start), data[offsets[start] : offsets[end]], own
            start = end


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
    """Begin, end and row of every word of a block; no word crosses a row."""
    if not len(data):
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing
    separator = separators[data]
    begins, ends = ~separator, ~separator
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    at_first, at_last = begins[first], ends[last]
    begins[1:] &= separator[:-1]
    ends[:-1] &= separator[1:]
    begins[first] = at_first
    ends[last] = at_last
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for every word, in chunks which stay in the processor's cache."""
    out = np.empty(len(starts), dtype=np.uint64)
    powers = np.ones(1, dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = int(np.searchsorted(starts, starts[a] + CHUNK_BYTES, "right"))
        lengths = ends[a:b] - starts[a:b]
        longest = int(lengths.max())
        if len(powers) < longest:
            powers = np.cumprod(np.full(longest, _POWER, dtype=np.uint64), dtype=np.uint64)
        begins = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        at = place + np.repeat(starts[a:b], lengths)
        out[a:b] = np.add.reduceat(_BYTE_CODES[data[at]] * powers[place], begins)
        a = b
    return mix(out)


def window_hashes(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash for each run of ``width`` values; the caller drops those which cross a row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * _WINDOW_CODES[which, k % 512] + np.uint64(k // 512)
    return mix(total)


def block_ids() -> Iterator[int]:
    """Numbers for the blocks of this task, other than those of any other task of the stage."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    while True:
        yield number
        number += 1


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key: its upper 32 bits, scaled."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def pack_keys(keys: np.ndarray) -> bytes:
    """The lower 32 bits of keys; with the bucket they tell keys apart."""
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4")


def segments(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0, 1, … for each length, one after the other."""
    lengths = np.asarray(lengths, dtype=np.int64)
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
