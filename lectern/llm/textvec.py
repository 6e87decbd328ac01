"""Words, hashes and hash exchanges over whole Arrow batches of text, without a Python loop per word.

Texts are handled as UTF-8 bytes in chunks of a few MB, so a worker's memory does not depend on the size
of a batch, a partition or the corpus (one text longer than a chunk is a chunk of its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK = 1 << 20
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit values."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse, for i up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK + 1, 2 * len(_powers[0]) if len(_powers[0]) > 1 else 0)
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, U(base))
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0], _powers[1]


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of each text in them); null texts are empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    off = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never goes over a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, and for each text the index of its first word (one more at the end)."""
    start, end = runs(~_SPACE[data], off)
    return start, end, np.searchsorted(start, off)


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], equal for equal bytes."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(0x9E3779B97F4A7C15))


class Sequence:
    """Hashes of any stretch of a list of hashes."""

    def __init__(self, items: np.ndarray):
        up, self.down = powers(len(items))
        self.up = up
        self.total = np.zeros(len(items) + 1, U)
        np.cumsum(items * up[: len(items)], out=self.total[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U) * U(0xA24BAED4963EE407))

    def without(self, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The hash of start..end with the item at `at` deleted; equals of() of that shorter stretch."""
        left = self.raw(start, at)
        right = self.raw(at + 1, end) * self.up[at - start]
        return mix(left + right + (end - start - 1).astype(U) * U(0xA24BAED4963EE407))


def ragged(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 3): owners 0 0 1 1 1 and positions 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def lean(run: Callable) -> Callable:
    """run, giving freed memory back at its end: workers wait for their next task with what they hold."""

    @wraps(run)
    def told(batches):
        try:
            yield from run(batches)
        finally:
            _powers[:] = [np.ones(1, U), np.ones(1, U)]
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return told


# ---- exchange of packed arrays ---------------------------------------------------------------------

Columns = dict[str, np.ndarray]


def packed(columns: Columns, part: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row for each part that occurs: its number and, as bytes, its share of every column."""
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(edge))
    rows = {"part": pa.array(used, pa.int32())}
    for name, values in columns.items():
        values = values[order]
        rows[name] = pa.array([values[edge[k] : edge[k + 1]].tobytes() for k in used], pa.binary())
    return pa.RecordBatch.from_pydict(rows)


def exchange(df: DataFrame, dtypes: dict[str, str], parts: int, meet: Callable[[Columns], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Deals the rows that packed() made out by part and calls meet() once with all columns of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            numbers = batch.column("part").to_numpy()
            for i in range(batch.num_rows):
                if now is not None and numbers[i] != now:
                    yield from meet(joined(held))
                    held = []
                now = numbers[i]
                held.append([batch.column(name)[i].as_buffer() for name in dtypes])
        if held:
            yield from meet(joined(held))

    def joined(held: list[list]) -> Columns:
        return {name: np.concatenate([np.frombuffer(row[k], kind) for row in held]) for k, (name, kind) in enumerate(dtypes.items())}

    return df.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(lean(run), schema)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
