"""Words, lines and windows of Arrow text columns as NumPy byte ranges and fingerprints.

All word rules of this subpackage are byte rules on UTF-8 (ASCII delimiters only), so a batch of texts
is cut with table look-ups instead of one regular expression call per text.  Work goes through the
batch in blocks of at most ``BLOCK_BYTES`` of text, which bounds the temporary arrays.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Bytes of text worked on at a time.
BLOCK_BYTES = 1 << 20

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32

#: Bytes of ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
ALNUM = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_low:_high] = True
#: Everything but the line feed.
LINES = np.ones(256, dtype=bool)
LINES[0x0A] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


class Cut:
    """The runs of bytes of one kind in the rows ``lo`` to ``hi`` of a column; ``seams`` finds bytes before which a run ends, too."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray, seams: Callable[[np.ndarray], np.ndarray] | None = None):
        self.base = int(offsets[0])
        self.bytes = buf[self.base:int(offsets[-1])]
        self.offsets = offsets - self.base
        self.mask = kind[self.bytes]
        before = np.empty_like(self.mask)
        before[1:] = self.mask[:-1]
        after = np.empty_like(self.mask)
        after[:-1] = self.mask[1:]
        edge = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        before[edge] = False
        after[self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1] = False
        if seams is not None:
            seam = seams(self.bytes)
            before[seam] = False
            after[:-1][seam[1:]] = False
        self.starts = np.flatnonzero(self.mask & ~before)
        self.ends = np.flatnonzero(self.mask & ~after) + 1
        #: Number of runs before each row, and the row of each run.
        self.first = np.searchsorted(self.starts, self.offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row carry a flag."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def fingerprints(self, fold: np.ndarray = AS_IS) -> np.ndarray:
        """64-bit fingerprints of the runs."""
        if not len(self):
            return np.empty(0, np.uint64)
        size = self.ends - self.starts
        first = np.cumsum(size) - size
        place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        values = fold[self.bytes[self.mask]].astype(np.uint64)
        values += np.uint64(1)
        values *= _powers_to(int(size.max()))[place]
        return mix(np.add.reduceat(values, first) ^ (size.astype(np.uint64) * _BASE))


def windows(marks: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of every ``width`` consecutive marks."""
    n = len(marks) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= _BASE
        out += marks[k:k + n]
    return mix(out)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


#: What this worker keeps for its later tasks, by kind.
_held: dict[str, dict] = {}


def held(kind: str) -> dict:
    return _held.setdefault(kind, {})


def let_go(keep: str | None = None) -> None:
    """Drop what earlier tasks left in this worker, but the kind ``keep``."""
    for kind, things in _held.items():
        if kind != keep:
            things.clear()


def tidy(run: Batches, keep: str | None = None) -> Batches:
    """``run``, whose worker gives freed memory back after each batch and at the end: idle workers stay with their executor.

    What other functions left in the worker is dropped first, but the kind ``keep``.
    """
    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    @wraps(run)
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            let_go(keep)
            for batch in run(batches):
                yield batch
                give_back()
        finally:
            give_back()

    return out


def with_columns(df: DataFrame, run: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[StructField], keep: str | None = None) -> DataFrame:
    """``df`` with further columns worked out per Arrow batch."""
    names = [*df.columns, *(f.name for f in fields)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *run(batch)], names=names)

    return df.mapInArrow(tidy(apply, keep), StructType([*df.schema.fields, *fields]))


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
