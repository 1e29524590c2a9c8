"""Helpers over the UTF-8 bytes of one text, used inside Arrow batches.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D). Hashes are 64-bit
polynomial hashes of the bytes, taken from prefix sums, so that a text costs a few array passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least `length` of them (kept per process)."""
    up, down = _powers.get(0, (np.ones(0, np.uint64), np.ones(0, np.uint64)))
    if len(up) < length:
        size = max(1 << 16, 1 << (length - 1).bit_length())
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        _powers[0] = up, down
    return up, down


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective finalizer of 64-bit values; different seeds act as different hash functions."""
    x = values + np.uint64((seed * _BASE + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of integer values, with a leading zero."""
    sums = np.zeros(len(values) + 1, np.uint64)
    up, _ = powers(len(values) + 1)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hashes of the spans [start, end) of the sequence behind `sums`."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of all windows of `width` consecutive values."""
    count = len(values) - width + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(values)
    _, down = powers(len(sums))
    return mix((sums[width:] - sums[:count]) * down[:count])


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words."""
    white = np.ones(len(data) + 2, dtype=bool)
    white[1:-1] = WHITE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word; equal words have equal hashes."""
    starts, ends = word_spans(data)
    hashes = span_hashes(prefix_sums(np.frombuffer(data, np.uint8)), starts, ends)
    return mix(hashes ^ (ends - starts).astype(np.uint64))


def covered(count: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Mask of the positions inside any of the spans [start, start + width)."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, count), -1)
    return np.cumsum(steps[:-1]) > 0


def to_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def filtered(docs: DataFrame, column: str, judge: Callable[[], Callable[[list[bytes]], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, whose text passes. `judge` is called once per task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = judge()
        for batch in batches:
            yield batch.filter(pa.array(passes(to_bytes(batch.column(column))), pa.bool_()))

    return docs.mapInArrow(task, docs.schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about `limit` bytes of the column, or one row."""
    for batch in batches:
        lengths = batch.column(column).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1])
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def least_hashed(frame: DataFrame, id_column: str, rows: int) -> DataFrame:
    """The distinct rows of a narrow frame that have the smallest hashes of their id, at most `rows`.

    A bound on the hash, from the approximate number of ids, leaves about four times as many before
    anything is ordered, so that no task or driver sees more, whatever the size. Null ids are left out.
    """
    named = frame.where(F.col(id_column).isNotNull())
    ids = named.agg(F.approx_count_distinct(id_column)).first()[0]
    bound = int(-(1 << 63) + min(1.0, 4 * rows / max(1, ids)) * ((1 << 64) - 1024)) if ids > 4 * rows else (1 << 63) - 1
    hashed = F.xxhash64(id_column)
    return named.where(hashed <= F.lit(bound)).distinct().orderBy(hashed, *frame.columns).limit(rows)
