"""Sums of Gaussians over all pairs of rows, without the pairs: moment expansions per box.

``potential(x) = sum over rows y of exp(-a |x - y|^2)`` with ``a = 4 / ra^2``, for rows of [0, 1]^d.  Boxes of side
``ra / SIDES`` hold the moments of their rows (sums of products of powers, up to ``ORDER`` per axis), which add up in
any order.  The kernel is a product over the axes, so the moments of all boxes become the Taylor coefficients of the
potential in every box by one small matrix per axis; their number depends on boxes and order, never on the rows.
Each row then evaluates the polynomial of its box.

Error: cutting the expansion of one axis at ``ORDER`` = 16 leaves at most (sqrt(2) b)^16 / sqrt(16!) of a row's weight,
b = sqrt(a) ra / (2 SIDES) = 1 / SIDES, which is 2e-14 for SIDES = 4; so a potential over n rows is off by less than
1e-13 n.  Up to ``MOST_AXES`` dimensions; rows with more are projected first, as the clustering jobs do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lumentab.session import ship_code, shuffle_width

ORDER, SIDES, MOST_AXES = 16, 4, 3
# Rows worked on at a time.
_ROWS = 4096


def _boxes(ra: float) -> int:
    return max(1, math.ceil(SIDES / ra - 1e-9))


def _placed(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The box of each row as numbers along the axes, and the row's place about the box's centre."""
    at = np.clip(np.floor(x * n).astype(np.int64), 0, n - 1)
    return at, x - (at + 0.5) / n


def _powers(u: np.ndarray) -> np.ndarray:
    """(axis, row, power) of places (row, axis)."""
    out = np.ones((u.shape[1], u.shape[0], ORDER))
    for k in range(1, ORDER):
        out[:, :, k] = out[:, :, k - 1] * u.T
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def moments(df: DataFrame, features: str, dims: int, ra: float) -> DataFrame:
    """(box, payload): the moments of each filled box, as bytes; at most boxes^dims rows."""
    n, scale = _boxes(ra), 2.0 / ra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                at, u = _placed(_vectors(batch.column(0).slice(lo, _ROWS)), n)
                box = reduce(lambda a, k: a * n + at[:, k], range(dims), np.zeros(len(at), np.int64))
                powers = _powers(u * scale)
                for b in np.unique(box):
                    own = powers[:, box == b]
                    tensor = own[0].T
                    for k in range(1, dims):
                        # Rows stay last until all axes are in.
                        tensor = (tensor[:, None, :] * own[k].T[None]).reshape(-1, own.shape[1])
                    total[int(b)] = total.get(int(b), 0.0) + tensor.sum(axis=1)
        yield from _packets(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                total[row["box"]] = total.get(row["box"], 0.0) + np.frombuffer(row["payload"])
        yield from _packets(total)

    pieces = df.select(features).mapInArrow(run, "box long, payload binary")
    return pieces.repartition(shuffle_width(df.sparkSession), "box").mapInArrow(added, "box long, payload binary")


def _packets(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for b, t in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([t.tobytes()], pa.binary())], names=["box", "payload"])


def _axis_matrix(n: int, ra: float) -> np.ndarray:
    """(box, power) of a target from (box, power) of a source, along one axis."""
    scale = 2.0 / ra
    centres = (np.arange(n) + 0.5) / n * scale
    gap = centres[:, None] - centres[None]
    # Derivatives of exp(-s^2) by the recurrence of Hermite polynomials: f_k+1 = -2 s f_k - 2 k f_k-1.
    f = np.empty((2 * ORDER, n, n))
    f[0] = np.exp(-gap * gap)
    f[1] = -2 * gap * f[0]
    for k in range(1, 2 * ORDER - 1):
        f[k + 1] = -2 * gap * f[k] - 2 * k * f[k - 1]
    inverse = 1.0 / np.array([math.factorial(k) for k in range(ORDER)], dtype=float)
    out = np.empty((n, ORDER, n, ORDER))
    for m in range(ORDER):
        for k in range(ORDER):
            out[:, m, :, k] = f[m + k] * ((-1) ** k * inverse[m] * inverse[k])
    return out.reshape(n * ORDER, n * ORDER)


def coefficients(found: DataFrame, dims: int, ra: float) -> dict[int, np.ndarray]:
    """Taylor coefficients of the potential in each filled box; bounded by boxes and order."""
    n = _boxes(ra)
    held = {r["box"]: np.frombuffer(r["payload"]).reshape((ORDER,) * dims) for r in found.toArrow().to_pylist()}
    whole = np.zeros((n, ORDER) * dims)
    for box, m in held.items():
        whole[tuple(x for b in np.unravel_index(box, (n,) * dims) for x in (int(b), slice(None)))] = m
    whole = whole.reshape((n * ORDER,) * dims)
    step = _axis_matrix(n, ra)
    for k in range(dims):
        whole = np.moveaxis(np.tensordot(step, whole, axes=(1, k)), 0, k)
    whole = whole.reshape((n, ORDER) * dims)
    return {box: whole[tuple(x for b in np.unravel_index(box, (n,) * dims) for x in (int(b), slice(None)))].ravel() for box in held}


def row_potentials(df: DataFrame, features: str, dims: int, ra: float, out: str = "potential") -> DataFrame:
    """``df`` with the potential of each row over all rows of [0, 1]^dims; a row that lacks a coordinate has none and adds nothing."""
    if not 1 <= dims <= MOST_AXES:
        raise ValueError(f"potentials need 1 to {MOST_AXES} dimensions; project the rows first")
    ship_code(df.sparkSession)
    n, scale = _boxes(ra), 2.0 / ra
    place = F.slice(F.col(features).cast("array<double>"), 1, dims)
    whole = F.col(features).isNotNull() & (F.size(features) >= dims) & F.forall(place, lambda x: x.isNotNull())
    rows = df.withColumn("_place", F.when(whole, place))
    known = coefficients(moments(rows.where(F.col("_place").isNotNull()), "_place", dims, ra), dims, ra)
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.full(batch.num_rows, np.nan)
            full = np.flatnonzero(batch.column(len(kept)).is_valid().to_numpy(zero_copy_only=False))
            for lo in range(0, len(full), _ROWS):
                own = full[lo:lo + _ROWS]
                at, u = _placed(_vectors(batch.column(len(kept)).take(pa.array(own))), n)
                box = reduce(lambda a, k: a * n + at[:, k], range(dims), np.zeros(len(at), np.int64))
                powers = _powers(u * scale)
                for b in np.unique(box):
                    here = np.flatnonzero(box == b)
                    tensor = known[int(b)].reshape((ORDER,) * dims)
                    # One axis after the other: (row, rest) shrinks to a number per row.
                    rest = powers[0][here] @ tensor.reshape(ORDER, -1)
                    for k in range(1, dims):
                        rest = np.einsum("rp,rpq->rq", powers[k][here], rest.reshape(len(here), ORDER, -1))
                    value[own[here]] = rest[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(value, from_pandas=True)], names=[*kept, out])

    return rows.select(*kept, "_place").mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))
