"""Numpy views of text batches, shared by the operators that work in Arrow batches.

Words of many documents are hashed together: one pass of table look-ups and running
sums over the bytes of a slice of the batch, without a Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# freed batches go back to the system, as workers outlive the stage they served
pa.set_memory_pool(pa.system_memory_pool())

#: Bytes of a batch that passes between Spark and a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20
#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_P = np.uint64(0x5851F42D4C957F2D)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1; kept for slices of usual size, made anew for a longer document."""
    key = str(base)
    if key in _powers and len(_powers[key]) >= n:
        return _powers[key][:n]
    out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if n <= SLICE_BYTES:
        _powers[key] = out
    return out[:n]


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded, so that rows of any size take the same memory."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) != str(BATCH_BYTES):
        conf.set(name, str(BATCH_BYTES))
    return df


def giving_back(task: Callable) -> Callable:
    """``task`` over Arrow batches; at its end freed memory goes back to the system, as far as the C library can do that."""

    def run(batches):
        yield from task(batches)
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; null is empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first word of each row and the total) of the maximal runs of non-separator bytes.

    ``separator`` and ``fold`` are tables over the 256 bytes.
    """
    n = len(data)
    bounds = offsets[:-1]
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[bounds[bounds < n]] = False  # a row begins
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = bounds[(bounds > 0)] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[fold[data]] * _power(_P, n), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power(_P_INV, n)[starts] + (ends - starts).astype(np.uint64) * _ODD
    return _mix(hashes), starts, ends, np.searchsorted(starts, offsets)


ASCII_FOLD = np.arange(256, dtype=np.uint8)
ASCII_FOLD[65:91] += 32
KEEP = np.arange(256, dtype=np.uint8)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes, at the place of the first."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * _P + hashes[k : k + m]
    return _mix(out + np.uint64(n) * _ODD)


def large_list(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def with_columns(df, added: dict):
    """(``df`` under the names c0, c1, ..., its schema with the added columns): for batches whose columns may share names."""
    plain = in_small_batches(df).toDF(*[f"c{k}" for k in range(len(df.columns))])
    return plain, T.StructType([*plain.schema.fields, *[T.StructField(n, t) for n, t in added.items()]])
