"""Near sites in many dimensions, by blocks of a kd-tree.

Planes from a bounded sample cut the sites into blocks of at most ``BLOCK``; they only balance the work.  A site asks
the blocks whose box its ball meets, and only those: questions and blocks meet in one shuffle, a task holds one block
and compares a few rows at a time.  Distances are added up axis by axis, as the column expressions of ``distance`` do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumentab.session import cut_lineage, shuffle_width

#: Sites of a block; rows of the sample that places the planes; distances that are held at a time; bytes of a batch.
BLOCK, SAMPLE, HELD, BATCH_BYTES = 4096, 50_000, 1 << 18, 4 << 20
#: Levels of planes at most.
DEEPEST = 12
NO_KEY = -(1 << 63)
_ROW = "at long, kind int, home long, place binary, x binary, k binary, w binary, core2 binary, bound binary"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 6]


@dataclass(frozen=True)
class Planes:
    """Cuts by heap number: sites above ``value`` on ``axis`` go right."""

    axis: np.ndarray
    value: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.ones(len(x), dtype=np.int64)
        for _ in range(int(math.log2(len(self.axis)))):
            node = 2 * node + (x[np.arange(len(x)), self.axis[node]] > self.value[node])
        return node


def planes_of(sites: DataFrame, dims: Sequence[str], rows: int) -> Planes:
    depth = min(DEEPEST, max(0, math.ceil(math.log2(max(rows, 1) / (0.75 * BLOCK)))))
    axis, value = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    if depth:
        drawn = sites.select(*dims).sample(min(1.0, SAMPLE / rows), seed=7).limit(2 * SAMPLE).toArrow()
        parts = {1: np.stack([c.to_numpy() for c in drawn.columns], axis=1)}
        for node in range(1, 1 << depth):
            x = parts.pop(node)
            if len(x):
                axis[node] = int(np.argmax(x.std(axis=0)))
                value[node] = np.median(x[:, axis[node]])
            right = x[:, axis[node]] > value[node]
            parts[2 * node], parts[2 * node + 1] = x[~right], x[right]
    return Planes(axis, value)


class Rows:
    """Sites or questions of a row: coordinates, keys and what else came with them."""

    def __init__(self, row: dict, width: int):
        self.at, self.home = row["at"], row["home"]
        self.place = None if row["place"] is None else np.frombuffer(row["place"], np.int64)
        self.x = np.frombuffer(row["x"]).reshape(-1, width)
        self.k, self.w = (np.frombuffer(row[c], np.int64) for c in ("k", "w"))
        self.core2, self.bound = (np.frombuffer(row[c]) for c in ("core2", "bound"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _bytes(*columns: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(c).tobytes() for c in columns]


def blocks_of(sites: DataFrame, dims: Sequence[str], planes: Planes, number: str = "w") -> DataFrame:
    """The sites (dims, k, w, core2, bound; NULL for none) as blocks, one row each.  ``number`` is the column read as w."""
    width, columns = len(dims), [*dims, "k", "w", "core2", "bound"]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy() for c in batch.columns[:width]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(planes.leaf_of(x))], names=[*columns, "leaf"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, leaf, chunk = [], None, 0

        def flush() -> pa.RecordBatch:
            body = np.concatenate([h[0] for h in held])
            ints = np.concatenate([h[1] for h in held], axis=1)
            at = leaf << 32 | chunk
            return _batch([(at, 0, at, None, *_bytes(body[:, :width], *ints, body[:, width], body[:, width + 1]))])

        for batch in batches:
            body = np.stack([c.to_numpy(zero_copy_only=False) for c in (*batch.columns[:width], *batch.columns[width + 2:width + 4])], axis=1)
            ints = np.stack([c.to_numpy() for c in batch.columns[width:width + 2]])
            own = batch.columns[-1].to_numpy()
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
                if not len(part):
                    continue
                if held and own[part[0]] != leaf:
                    yield flush()
                    held = []
                if own[part[0]] != leaf:
                    leaf, chunk = int(own[part[0]]), 0
                while len(part):
                    room = BLOCK - sum(len(h[0]) for h in held)
                    held.append((body[part[:room]], ints[:, part[:room]]))
                    part = part[room:]
                    if len(part):
                        yield flush()
                        held, chunk = [], chunk + 1
        if held:
            yield flush()

    full = sites.select(*dims, *[F.coalesce(F.col(c).cast("long"), F.lit(NO_KEY)).alias(n) for c, n in (("k", "k"), (number, "w"))],
                        F.coalesce(F.col("core2"), F.lit(math.inf)).alias("core2"), F.coalesce(F.col("bound"), F.lit(-1.0)).alias("bound"))
    schema = ", ".join(f"`{c}` {'long' if c in ('k', 'w') else 'double'}" for c in columns) + ", leaf long"
    dealt = full.mapInArrow(leaves, schema).repartition(shuffle_width(sites.sparkSession), "leaf").sortWithinPartitions("leaf")
    return cut_lineage(dealt.mapInArrow(pack, _ROW))


def boxes_of(blocks: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and corners of the blocks: a few numbers for some thousand sites each."""
    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = Rows(row, width).x
                yield pa.RecordBatch.from_pydict({"at": [row["at"]], "lo": [x.min(axis=0).tobytes()], "hi": [x.max(axis=0).tobytes()]})

    told = blocks.mapInArrow(corners, "at long, lo binary, hi binary").toArrow()
    lo, hi = (np.frombuffer(b"".join(told[c].to_pylist())).reshape(-1, width) for c in ("lo", "hi"))
    return told["at"].to_numpy(), lo, hi


def gaps_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = np.subtract.outer(a[:, i], b[:, i])
        gap *= gap
        out += gap
    return out


def _box_gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(lo)))
    for i in range(x.shape[1]):
        gap = np.maximum(np.maximum(lo[:, i] - x[:, i, None], x[:, i, None] - hi[:, i]), 0.0)
        out += gap * gap
    return out


def chunks(rows: int, width: int) -> Iterator[slice]:
    step = max(1, HELD // max(width, 1))
    return (slice(lo, lo + step) for lo in range(0, rows, step))


def ask(blocks: DataFrame, width: int, bound: Callable[[Rows], np.ndarray]) -> DataFrame:
    """The blocks, sorted, each followed by its questions: sites whose ball of squared radius ``bound`` meets its box.

    A negative bound asks nothing.
    """
    names, lo, hi = boxes_of(blocks, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b, out, size = Rows(row, width), [], 0
                limit = bound(b)
                asking = np.flatnonzero(limit >= 0)
                meets = np.zeros((len(asking), len(names)), dtype=bool)
                for s in chunks(len(asking), len(names)):
                    meets[s] = _box_gaps(b.x[asking[s]], lo, hi) <= limit[asking[s], None]
                for t in np.flatnonzero(meets.any(axis=0)):
                    own = asking[meets[:, t]]
                    out.append((int(names[t]), 1, b.home, *_bytes(own, b.x[own], b.k[own], b.w[own], b.core2[own], limit[own])))
                    size += len(own) * 8 * (width + 5)
                    if size > BATCH_BYTES:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    asked = blocks.mapInArrow(run, _ROW).unionByName(blocks)
    return asked.repartition(shuffle_width(blocks.sparkSession), "at").sortWithinPartitions("at", "kind")


def met(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Rows, Rows]]:
    """Each question with its block."""
    block = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                block = Rows(row, width)
            else:
                yield Rows(row, width), block


# ---------------------------------------------------------------- nearest sites

def nearest(blocks: DataFrame, dims: Sequence[str], count: int, radius: float, min_pts: int) -> DataFrame:
    """Every site (dims, k, w) with its ``count`` nearest sites within ``radius``, itself included.

    ``others`` and ``gaps`` are their keys and squared distances, nearest first.  ``core2`` is the squared distance
    that holds ``min_pts`` rows, NULL if the radius does not.  ``reach2`` is the squared distance up to which no site
    is left out of the list, NULL if the list is whole.
    """
    width, limit = len(dims), radius * radius

    def bound(b: Rows) -> np.ndarray:
        if len(b.x) < count:
            return np.full(len(b.x), limit)
        out = np.empty(len(b.x))
        for s in chunks(len(b.x), len(b.x)):
            out[s] = np.partition(gaps_between(b.x[s], b.x), count - 1, axis=1)[:, count - 1]
        return np.minimum(out, limit)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, b in met(batches, width):
            found = []
            for s in chunks(len(q.x), len(b.x)):
                gaps = gaps_between(q.x[s], b.x)
                if len(b.x) > count:
                    cols = np.argpartition(gaps, count - 1, axis=1)[:, :count]
                else:
                    cols = np.broadcast_to(np.arange(len(b.x)), gaps.shape)
                near = np.take_along_axis(gaps, cols, axis=1)
                i, j = np.nonzero(near <= q.bound[s, None])
                found.append((q.place[s][i], near[i, j], cols[i, j]))
            place, gap, col = (np.concatenate(c) for c in zip(*found))
            if len(place):
                yield _batch([(q.home, 1, b.home, *_bytes(place, np.empty(0), b.k[col], b.w[col], gap, np.empty(0)))])

    def best(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        place, gap, k, w = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((k, gap, place))
        place = place[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place, side="left")
        keep = order[rank < count]
        return tuple(c[keep] for c in (np.concatenate([h[0] for h in held]), gap, k, w))

    def lists(b: Rows, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        place, gap, k, w = best(held) if held else (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))
        starts = np.searchsorted(place, np.arange(len(b.x) + 1)).astype(np.int32)
        total = np.concatenate(([0], np.cumsum(w)))
        rows = total[1:] - total[starts[place]]
        core2 = np.full(len(b.x), np.inf)
        np.minimum.at(core2, place[rows >= min_pts], gap[rows >= min_pts])
        whole = np.diff(starts) < count
        reach2 = np.array([0.0 if f else gap[e - 1] for f, e in zip(whole, starts[1:])])
        core2[b.k == NO_KEY] = np.inf
        return pa.RecordBatch.from_arrays([
            *[pa.array(np.ascontiguousarray(c)) for c in b.x.T], pa.array(b.k, mask=b.k == NO_KEY), pa.array(b.w),
            pa.array(core2, mask=np.isinf(core2)), pa.array(reach2, mask=whole),
            pa.ListArray.from_arrays(pa.array(starts), pa.array(k)), pa.ListArray.from_arrays(pa.array(starts), pa.array(gap))],
            names=[*dims, "k", "w", "core2", "reach2", "others", "gaps"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if block is not None:
                        yield lists(block, held)
                    block, held, size = Rows(row, width), [], 0
                    continue
                a = Rows(row | {"x": b""}, width)
                held.append((a.place, a.core2, a.k, a.w))
                size += len(a.place)
                if size > 16 * BLOCK * count:
                    held = [best(held)]
                    size = len(held[0][0])
        if block is not None:
            yield lists(block, held)

    told = ask(blocks, width, bound).mapInArrow(answer, _ROW).unionByName(blocks)
    dealt = told.repartition(shuffle_width(blocks.sparkSession), "at").sortWithinPartitions("at", "kind")
    return dealt.mapInArrow(gather, ", ".join(f"`{d}` double" for d in dims) + ", k long, w long, core2 double, reach2 double, others array<long>, gaps array<double>")


def edges_within(blocks: DataFrame, width: int, reduce: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Edges (a, b, far2) from every site of the blocks to the sites whose mutual reachability is within its ``bound``; ``reduce`` runs in the task."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, b in met(batches, width):
            for s in chunks(len(q.x), len(b.x)):
                far = np.maximum(np.maximum(gaps_between(q.x[s], b.x), q.core2[s, None]), b.core2)
                i, j = np.nonzero((far <= q.bound[s, None]) & (q.k[s, None] != b.k))
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(q.k[s][i]), pa.array(b.k[j]), pa.array(far[i, j])], names=["a", "b", "far2"])

    return ask(blocks, width, lambda b: b.bound).mapInArrow(lambda batches: reduce(pairs(batches)), "a long, b long, far2 double")


def least_within(blocks: DataFrame, width: int) -> DataFrame:
    """(_asked, near): of every site with a ``bound`` its key and the smallest ``w`` of the sites within it; sites without ``w`` have none."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, b in met(batches, width):
            some = b.w != NO_KEY
            x, w = b.x[some], b.w[some]
            for s in chunks(len(q.x), len(x)):
                i, j = np.nonzero(gaps_between(q.x[s], x) <= q.bound[s, None])
                out = np.full(len(q.x[s]), np.iinfo(np.int64).max)
                np.minimum.at(out, i, w[j])
                own = np.unique(i)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(q.k[s][own]), pa.array(out[own])], names=["_asked", "near"])

    found = ask(blocks, width, lambda b: b.bound).mapInArrow(least, "_asked long, near long")
    return found.groupBy("_asked").agg(F.min("near").alias("near"))
