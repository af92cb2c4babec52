"""Whole groups from Arrow batches whose rows come sorted by the group's key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def _changes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    for k in keys:
        values = table.column(k).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, bounds): group g of the table is the rows bounds[g] to bounds[g + 1]."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        change = _changes(table, keys)
        if not len(change):
            held.append(batch)
            continue
        yield table.slice(0, change[-1]), np.concatenate(([0], change))
        held = table.slice(change[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])
