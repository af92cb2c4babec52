"""Gradient boosting over histograms, for many settings at once: leaf-wise trees, L2, missing cells, softmax.

Rows are reduced to *cells* first: rows of one part with the same bins and label differ in nothing that a tree
sees, so they become one weighted row.  Cells are packed into blocks (columns as bytes, with the raw predictions
of every run), and each round passes over the blocks a few times:

* A pass carries the trees grown so far and the nodes whose best split is wanted, of all runs and classes
  together.  Blocks send mergeable sums of gradient, hessian, rows and cells keyed by (tree, node, feature, bin).
* A node of at most ``LOCAL`` cells is sent as its cells instead, and grown on in the task that gets them, so small
  subtrees need one pass.  Both ways give the same splits.
* A table of at most ``LOCAL`` cells needs no passes: runs are dealt to tasks and each grows all its trees there.
* Splits come back as one short row each.  The driver holds only trees: it takes splits best first until the leaf
  limit, and asks for the children of those taken.

Numbers of rounds share one run: a run of 200 rounds is read off at 50 and 100.  Predictions are written to the
checkpoint folder every ``CUT_EVERY`` rounds; in between, a pass adds the few trees grown since to what it reads.

Rules: gain and leaf value are those of second-order boosting, G^2 / (H + l2) and -rate * G / (H + l2); a leaf has at
least ``min_leaf`` rows and a hessian of ``LEAST_HESSIAN``; ties go to the lower feature, then the lower bin, then to
missing cells on the right; equal gains of nodes to the lower node.  Missing cells (NULL or NaN) go where the gain is
larger; if a node has none, later ones go to its larger child.  Bins are cut half-way between distinct values, or at
quantiles where a feature has more than ``BINS`` of them; they never depend on labels.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lumentab.session import cut_lineage, ship_code, shuffle_width

BINS, MISSING = 255, 255
LEAST_HESSIAN = 1e-3
#: Cells of a node that is grown in one task; bytes of predictions in a block; rounds between checkpoints.
LOCAL, BLOCK_BYTES, CUT_EVERY = 200_000, 8 << 20, 5
#: Cells of a partition at least: fewer are not worth a task.
PART_CELLS = 20_000
# Node numbers are those of a heap (children 2 n and 2 n + 1), which bounds the depth.
DEEPEST = 60
_CHANNELS = 4  # gradient, hessian, rows, cells


@dataclass(frozen=True)
class Setting:
    """One point of a search.  ``held`` is the number of the part that is left out of training."""

    rounds: int = 100
    leaves: int | None = 31
    rate: float = 0.1
    l2: float = 0.0
    min_leaf: int = 20
    depth: int | None = None
    held: int = -1


@dataclass
class Split:
    feature: int
    cut: int
    missing_left: bool
    gain: float
    left: tuple[float, ...]
    right: tuple[float, ...]


@dataclass
class Tree:
    """Splits by node, and the value of each leaf."""

    splits: dict[int, Split] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def packed(self) -> Packed:
        """As arrays, parents first, which are quick to send to tasks."""
        at = sorted(self.splits)
        own = [self.splits[n] for n in at]
        names = sorted(self.values)
        return Packed(
            np.array(at, np.int64), np.array([s.feature for s in own], np.int16), np.array([s.cut for s in own], np.int16),
            np.array([s.missing_left for s in own], bool), np.array(names, np.int64), np.array([self.values[n] for n in names]))


class Packed(NamedTuple):
    at: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    names: np.ndarray
    values: np.ndarray


# ---------------------------------------------------------------- bins and cells

def fit_bins(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Cut points of each feature: at most ``BINS`` - 1."""
    out = []
    for c in features:
        known = df.select(F.col(c).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
        values = np.sort(np.array([r[0] for r in known.distinct().limit(BINS + 1).collect()], dtype=np.float64))
        if len(values) <= BINS:
            out.append((values[1:] + values[:-1]) / 2)
            continue
        probs = [(i + 1) / BINS for i in range(BINS - 1)]
        out.append(np.unique(np.array(known.agg(F.percentile_approx("v", probs, 1 << 16)).first()[0], dtype=np.float64)))
    return out


def binned(columns: Sequence[pa.Array], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of numeric columns, one row per row; a value equal to a cut lies to its left."""
    out = np.empty((len(columns[0]), len(cuts)), dtype=np.uint8)
    for k, (c, own) in enumerate(zip(columns, cuts)):
        values = c.cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, k] = np.where(np.isnan(values), MISSING, np.searchsorted(own, values, side="left"))
    return out


def cells_of(df: DataFrame, features: Sequence[str], label: str, part: str | None, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(bins, y, part, w): the rows of each distinct cell."""
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.select(*columns, F.col(label).cast("int").alias("y"), (F.col(part) if part else F.lit(0)).cast("int").alias("part")).where("y IS NOT NULL AND part IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = binned(batch.columns[:len(cuts)], cuts)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), *batch.columns[-2:]], names=["bins", "y", "part"])

    return rows.mapInArrow(run, "bins binary, y int, part int").groupBy("bins", "y", "part").agg(F.count(F.lit(1)).alias("w"))


_BLOCK = "bins binary, y binary, part binary, w binary, raw binary"


class Block:
    """The columns of a block; ``raw`` has a row of predictions per (run, class)."""

    def __init__(self, row: Mapping[str, bytes], features: int, tracks: int):
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, features)
        self.y, self.part = np.frombuffer(row["y"], np.int32), np.frombuffer(row["part"], np.int32)
        self.w, self.raw = np.frombuffer(row["w"], np.int64), np.frombuffer(row["raw"], np.float64)
        if tracks:
            self.raw = self.raw.reshape(tracks, -1)


def _blocks(batches: Iterator[pa.RecordBatch], features: int, tracks: int) -> Iterator[Block]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Block(row, features, tracks)


def _packed(bins, y, part, w, raw) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x.tobytes()], pa.binary()) for x in (bins, y, part, w, raw)], names=["bins", "y", "part", "w", "raw"])


def _pack(cells: DataFrame, base: np.ndarray, features: int, partitions: int) -> DataFrame:
    """Blocks of cells with the first predictions ``base``, one per (run, class)."""
    size = max(256, BLOCK_BYTES // (8 * len(base)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                t = batch.slice(lo, size)
                bins = np.frombuffer(b"".join(t.column(0).to_pylist()), np.uint8).reshape(-1, features)
                raw = np.repeat(base[:, None], t.num_rows, axis=1)
                yield _packed(bins, *(t.column(k).to_numpy(zero_copy_only=False).astype(d) for k, d in ((1, np.int32), (2, np.int32), (3, np.int64))), raw)

    return cells.repartition(partitions, "bins").sortWithinPartitions("bins", "y", "part").mapInArrow(run, _BLOCK)


# ---------------------------------------------------------------- trees

def _leaves(tree: Packed, bins: np.ndarray) -> dict[int, np.ndarray]:
    """The rows of each leaf."""
    rows = {1: np.arange(len(bins))}
    for at, f, cut, missing_left in zip(*(c.tolist() for c in tree[:4])):
        here = rows.pop(at)
        x = bins[here, f]
        left = x <= cut
        if missing_left:
            left |= x == MISSING
        rows[2 * at], rows[2 * at + 1] = here[left], here[~left]
    return rows


def leaf_of(tree: Packed, bins: np.ndarray) -> np.ndarray:
    """The node each row falls into."""
    node = np.empty(len(bins), dtype=np.int64)
    for n, rows in _leaves(tree, bins).items():
        node[rows] = n
    return node


def _values(tree: Packed, bins: np.ndarray) -> np.ndarray:
    """What the tree adds to each row."""
    out = np.empty(len(bins))
    value = dict(zip(tree.names.tolist(), tree.values.tolist()))
    for n, rows in _leaves(tree, bins).items():
        out[rows] = value[n]
    return out


def places(bins: np.ndarray) -> np.ndarray:
    """Where the bins of each row lie in a flat histogram."""
    return bins.astype(np.intp) + 256 * np.arange(bins.shape[1], dtype=np.intp)


def sums(bins: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Histogram (feature, bin, channel) of cells."""
    return placed_sums(places(bins), g, h, w)


def placed_sums(place: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    f = place.shape[1]
    place = place.ravel()
    out = np.empty((f * 256, _CHANNELS))
    for k, v in enumerate((g, h, w)):
        out[:, k] = np.bincount(place, weights=np.repeat(v, f), minlength=f * 256)
    out[:, 3] = np.bincount(place, minlength=f * 256)
    return out.reshape(f, 256, _CHANNELS)


def best_split(hist: np.ndarray, l2: float, min_leaf: int) -> Split | None:
    """The split of largest gain of a node given by its histogram."""
    total = hist[0].sum(axis=0)
    # First missing cells on the right, then on the left, which differ only if there are any.
    sides = 2 if hist[:, MISSING, 3].any() else 1
    g, h, w = left = np.empty((3, len(hist), MISSING, sides))
    for k in range(3):
        np.cumsum(hist[:, :MISSING, k], axis=1, out=left[k, ..., 0])
        if sides == 2:
            left[k, ..., 1] = left[k, ..., 0] + hist[:, MISSING:, k]
    right_h, right_w = total[1] - h, total[2] - w
    fits = (w >= min_leaf) & (right_w >= min_leaf) & (h >= LEAST_HESSIAN) & (right_h >= LEAST_HESSIAN)
    at = np.flatnonzero(fits)
    if not len(at):
        return None
    g, h, right_h = g.ravel()[at], h.ravel()[at], right_h.ravel()[at]
    right_g = total[0] - g
    gain = g ** 2 / (h + l2) + right_g ** 2 / (right_h + l2) - total[0] ** 2 / (total[1] + l2)
    # Rounding makes ties of equal splits whose sums were added in another order.
    gain = np.round(gain, 9)
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return None
    f, cut, side = np.unravel_index(at[best], fits.shape)
    a = hist[f, :cut + 1].cumsum(axis=0)[-1]
    if side:
        a = a + hist[f, MISSING]
    b = total - a
    to_left = bool(side) if hist[f, MISSING, 3] else bool(a[2] >= b[2])
    return Split(int(f), int(cut), to_left, float(gain[best]), tuple(map(float, a)), tuple(map(float, b)))


def may_split(node: int, rows: float, s: Setting) -> bool:
    depth = node.bit_length() - 1
    return rows >= 2 * s.min_leaf and depth < min(s.depth if s.depth is not None else DEEPEST, DEEPEST)


def grow_on(node: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray, w: np.ndarray, s: Setting) -> Iterator[tuple[int, Split]]:
    """The splits below ``node`` that could be taken: best first, as many as a tree may have."""
    heap: list[tuple] = []
    place = places(bins)

    def offer(at: int, rows: np.ndarray) -> None:
        if may_split(at, w[rows].sum(), s):
            found = best_split(placed_sums(place[rows], g[rows], h[rows], w[rows]), s.l2, s.min_leaf)
            if found:
                heapq.heappush(heap, (-found.gain, at, found, rows))

    offer(node, np.arange(len(g)))
    taken = 0
    while heap and (s.leaves is None or taken < s.leaves - 1):
        _, at, found, rows = heapq.heappop(heap)
        yield at, found
        taken += 1
        x = bins[rows, found.feature]
        left = np.where(x == MISSING, found.missing_left, x <= found.cut)
        offer(2 * at, rows[left])
        offer(2 * at + 1, rows[~left])


class Growing:
    """A tree between passes: the splits known, those taken, and the nodes to ask for."""

    def __init__(self, s: Setting, root: tuple[float, ...]):
        self.s, self.tree = s, Tree()
        self.stats: dict[int, tuple[float, ...]] = {1: root}
        self.known: dict[int, Split | None] = {}
        self.grown: set[int] = set()
        self.wanted = self._ask([1])

    def _ask(self, nodes: Sequence[int]) -> list[int]:
        return [n for n in nodes if n not in self.known and may_split(n, self.stats[n][2], self.s)]

    def learn(self, found: Mapping[int, Split], asked: Sequence[int], local: Sequence[int]) -> None:
        """Take in the answers, and take splits best first as far as they are known."""
        self.known.update({n: None for n in asked})
        self.known.update(found)
        self.grown.update(local)
        heap, taken, ask = [], {}, []

        def offer(n: int) -> None:
            s = self.known.get(n)
            if s is not None:
                heapq.heappush(heap, (-s.gain, n))
            elif n not in self.known and not self._inside(n):
                ask.extend(self._ask([n]))

        offer(1)
        while heap and (self.s.leaves is None or len(taken) < self.s.leaves - 1):
            _, n = heapq.heappop(heap)
            s = taken[n] = self.known[n]
            self.stats[2 * n], self.stats[2 * n + 1] = s.left, s.right
            offer(2 * n)
            offer(2 * n + 1)
        self.tree.splits, self.wanted = taken, ask

    def _inside(self, n: int) -> bool:
        """Whether a task has grown the subtree of ``n``: what it did not return has no split."""
        while n and n not in self.grown:
            n >>= 1
        return bool(n)

    def close(self) -> Tree:
        inner = self.tree.splits
        leaves = [1] if not inner else [c for n in inner for c in (2 * n, 2 * n + 1) if c not in inner]
        for n in leaves:
            g, h, *_ = self.stats[n]
            self.tree.values[n] = -self.s.rate * g / (h + self.s.l2) if h + self.s.l2 > 0 else 0.0
        return self.tree


# ---------------------------------------------------------------- passes

def _gradients(raw: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted gradient and hessian of class ``k``; ``raw`` has the run's rows."""
    if classes == 2:
        p, hit = 1 / (1 + np.exp(-raw[0])), y == 1
    else:
        e = np.exp(raw - raw.max(axis=0))
        p, hit = (e / e.sum(axis=0))[k], y == k
    return w * (p - hit), w * p * (1 - p)


_PIECE = "tree int, node long, local boolean, payload binary"
_SPLIT = "tree int, node long, feature int, cut int, missing_left boolean, gain double, stats array<double>"
#: tree -> (splits so far, nodes asked for with whether they are grown in a task)
Plan = dict[int, tuple[Packed, list[tuple[int, bool]]]]


def _added(b: Block, since: Sequence[Mapping[int, Packed]]) -> np.ndarray:
    """The raw predictions of a block with the trees of further rounds."""
    raw = b.raw.copy()
    for trees in since:
        for t, tree in trees.items():
            raw[t] += _values(tree, b.bins)
    return raw


def _pieces(plan: Plan, since: Sequence[Mapping[int, Packed]], runs: Sequence[Setting], classes: int, features: int) -> Callable:
    tracks_of_run = 1 if classes == 2 else classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in _blocks(batches, features, len(runs) * tracks_of_run):
            rows, now = [], _added(b, since)
            for tree, (grown, nodes) in plan.items():
                r, k = divmod(tree, tracks_of_run)
                raw = now[r * tracks_of_run:(r + 1) * tracks_of_run]
                node = leaf_of(grown, b.bins)
                used = b.part != runs[r].held
                g, h = _gradients(raw, b.y, b.w, classes, k)
                for n, local in nodes:
                    at = np.flatnonzero(used & (node == n))
                    if local and len(at):
                        cells = b"".join(x[at].astype(np.float64).tobytes() for x in (g, h, b.w))
                        rows.append((tree, n, True, b.bins[at].tobytes() + cells))
                    elif len(at):
                        own = sums(b.bins[at], g[at], h[at], b.w[at])
                        held[tree, n] = held[tree, n] + own if (tree, n) in held else own
            if rows:
                yield _rows_of(rows)
        for (tree, n), own in held.items():
            yield _rows_of([(tree, n, False, own.tobytes())])

    return run


def _rows_of(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["tree", "node", "local", "payload"])


def _answers(runs: Sequence[Setting], tracks: int, features: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hists: dict[tuple[int, int], np.ndarray] = {}
        cells: dict[tuple[int, int], list[bytes]] = defaultdict(list)
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["tree"], row["node"])
                if row["local"]:
                    cells[key].append(row["payload"])
                else:
                    own = np.frombuffer(row["payload"]).reshape(features, 256, _CHANNELS)
                    hists[key] = hists[key] + own if key in hists else own
        # The sums of a root go back as well, under feature -1: they are its leaf if nothing splits it.
        found = []
        for (tree, node), hist in hists.items():
            s = runs[tree // tracks]
            if node == 1:
                found.append((tree, node, Split(-1, 0, False, 0.0, tuple(hist[0].sum(axis=0)), ())))
            split = best_split(hist, s.l2, s.min_leaf)
            if split:
                found.append((tree, node, split))
        for (tree, node), parts in cells.items():
            bins, values = [], []
            for p in sorted(parts):
                n = len(p) // (features + 24)
                bins.append(np.frombuffer(p[:n * features], np.uint8).reshape(-1, features))
                values.append(np.frombuffer(p[n * features:]).reshape(3, -1))
            g, h, w = np.concatenate(values, axis=1)
            if node == 1:
                found.append((tree, node, Split(-1, 0, False, 0.0, (g.sum(), h.sum(), w.sum(), float(len(g))), ())))
            found += [(tree, n, s) for n, s in grow_on(node, np.concatenate(bins), g, h, w, runs[tree // tracks])]
        if found:
            t, n, s = zip(*found)
            yield pa.RecordBatch.from_arrays([
                pa.array(t, pa.int32()), pa.array(n, pa.int64()), pa.array([x.feature for x in s], pa.int32()), pa.array([x.cut for x in s], pa.int32()),
                pa.array([x.missing_left for x in s]), pa.array([x.gain for x in s]), pa.array([[*x.left, *x.right] for x in s], pa.list_(pa.float64()))],
                names=["tree", "node", "feature", "cut", "missing_left", "gain", "stats"])

    return run


def _updated(since: Sequence[Mapping[int, Packed]], features: int, tracks: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, features, tracks):
            yield _packed(b.bins, b.y, b.part, b.w, _added(b, since))

    return run


def probabilities(raw: np.ndarray, classes: int) -> np.ndarray:
    """Class probabilities, one row per class, of one run's raw predictions."""
    if classes == 2:
        p = 1 / (1 + np.exp(-raw[0]))
        return np.stack((1 - p, p))
    e = np.exp(raw - raw.max(axis=0))
    return e / e.sum(axis=0)


def _scored(runs: Sequence[Setting], wanted: Sequence[int], classes: int, features: int, rounds: int) -> Callable:
    width = 1 if classes == 2 else classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, features, len(runs) * width):
            for r in wanted:
                yield _score_rows(r, rounds, b, probabilities(b.raw[r * width:(r + 1) * width], classes), classes)

    return run


_SCORED = "run int, rounds int, part int, y int, w long, probability array<double>"


def _score_rows(r: int, rounds: int, b: Block, p: np.ndarray, classes: int) -> pa.RecordBatch:
    n = len(b.y)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, r, np.int32)), pa.array(np.full(n, rounds, np.int32)), pa.array(b.part), pa.array(b.y), pa.array(b.w),
        pa.FixedSizeListArray.from_arrays(pa.array(p.T.ravel()), classes).cast(pa.list_(pa.float64()))],
        names=["run", "rounds", "part", "y", "w", "probability"])


# ---------------------------------------------------------------- whole runs in tasks

_TREE = "at array<long>, feature array<int>, cut array<int>, missing_left array<boolean>, names array<long>, values array<double>"
_RUN = f"run int, rounds int, class int, part binary, y binary, w binary, raw binary, {_TREE}"


def _run_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"run": pa.int32(), "rounds": pa.int32(), "class": pa.int32(), "part": pa.binary(), "y": pa.binary(), "w": pa.binary(), "raw": pa.binary(),
             "at": pa.list_(pa.int64()), "feature": pa.list_(pa.int32()), "cut": pa.list_(pa.int32()), "missing_left": pa.list_(pa.bool_()),
             "names": pa.list_(pa.int64()), "values": pa.list_(pa.float64())}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()], names=list(kinds))


def _whole_runs(runs: Sequence[Setting], bases: Sequence[np.ndarray], asked: Mapping[int, Sequence[int]], last: Sequence[int], classes: int, features: int) -> Callable:
    """Every round of a run over the cells that come with its number: its trees, and its raw predictions at the rounds asked for."""
    width = 1 if classes == 2 else classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[dict]] = defaultdict(list)
        for batch in batches:
            for row in batch.to_pylist():
                blocks[row["run"]].append(row)
        for r in sorted(blocks):
            parts = sorted(blocks.pop(r), key=lambda row: row["bins"])
            row = {c: b"".join(p[c] for p in parts) for c in ("bins", "y", "part", "w", "raw")}
            s, b = runs[r], Block(row, features, 0)
            raw = np.repeat(bases[r][:, None], len(b.y), axis=1)
            used = np.flatnonzero(b.part != s.held)
            bins, w, told = b.bins[used], b.w[used], []
            w_float = w.astype(np.float64)
            for t in range(last[r]):
                trees = []
                for k in range(width):
                    g, h = _gradients(raw[:, used], b.y[used], w, classes, k)
                    growing = Growing(s, (0.0, 0.0, w_float.sum(), float(len(g))))
                    if growing.wanted:
                        growing.stats[1] = (g.sum(), h.sum(), w_float.sum(), float(len(g)))
                        growing.learn(dict(grow_on(1, bins, g, h, w_float, s)), [1], [1])
                    trees.append(growing.close().packed())
                for k, tree in enumerate(trees):
                    raw[k] += _values(tree, b.bins)
                    told.append({"run": r, "rounds": t + 1, "class": k} | tree._asdict())
                if r in asked.get(t + 1, ()):
                    told.append({"run": r, "rounds": t + 1, "raw": raw.tobytes()} | {c: row[c] for c in ("part", "y", "w")})
            yield _run_rows(told)

    return run


def _scored_runs(classes: int) -> Callable:
    width = 1 if classes == 2 else classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row | {"bins": b""}, 1, width)
                yield _score_rows(row["run"], row["rounds"], b, probabilities(b.raw, classes), classes)

    return run


def _fit_whole_runs(state: DataFrame, models: Sequence[Boosted], runs: Sequence[Setting], asked: Mapping[int, Sequence[int]],
                    last: Sequence[int], classes: int, features: int) -> DataFrame:
    """Fit runs over few cells side by side, each in one task; fills ``models`` and gives the scored cells."""
    width = shuffle_width(state.sparkSession)
    numbered = state.drop("raw").select("*", F.lit(b"").alias("raw"), F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run"))
    # By ranges, so that no two runs share a task while others have none.
    dealt = numbered.repartitionByRange(max(1, min(len(runs), 16 * width)), "run")
    told = cut_lineage(dealt.mapInArrow(_whole_runs(runs, [m.base for m in models], asked, last, classes, features), _RUN))
    trees = told.where("raw IS NULL").drop("part", "y", "w", "raw").orderBy("run", "rounds", "class").toArrow().combine_chunks()
    flat = [(trees[c].combine_chunks(), t) for c, t in zip(Packed._fields, (np.int64, np.int16, np.int16, bool, np.int64, np.float64))]
    columns = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False).astype(t)) for c, t in flat]
    for i, (r, k) in enumerate(zip(trees["run"].to_pylist(), trees["class"].to_pylist())):
        own = models[r].rounds
        if k == 0:
            own.append([])
        own[-1].append(Packed(*(values[at[i]:at[i + 1]] for at, values in columns)))
    marks = told.where("raw IS NOT NULL").select("run", "rounds", "part", "y", "w", "raw")
    return marks.mapInArrow(_scored_runs(classes), _SCORED)


# ---------------------------------------------------------------- fitting

@dataclass
class Boosted:
    """A fitted run: trees by round and class over binned features."""

    features: list[str]
    cuts: list[np.ndarray]
    classes: int
    base: np.ndarray
    rounds: list[list[Packed]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (an array over classes) and ``prediction``; cells may be missing."""
        ship_code(df.sparkSession)
        me, names = self, [f"_x{i}" for i in range(len(self.features))]
        kept = df.columns
        wide = df.select(*kept, *[F.col(c).cast("double").alias(n) for c, n in zip(self.features, names)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = binned(batch.columns[len(kept):], me.cuts)
                raw = np.repeat(me.base[:, None], len(bins), axis=1)
                for trees in me.rounds:
                    for k, tree in enumerate(trees):
                        raw[k] += _values(tree, bins)
                p = probabilities(raw, me.classes)
                told = pa.FixedSizeListArray.from_arrays(pa.array(p.T.ravel()), me.classes).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(kept)], told, pa.array(p.argmax(axis=0).astype(np.float64))], names=[*kept, "probability", "prediction"])

        schema = T.StructType([*df.schema.fields, T.StructField("probability", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())])
        return wide.mapInArrow(run, schema)


def _base(counts: np.ndarray, classes: int) -> np.ndarray:
    """First raw predictions from rows per class: log odds, or log shares."""
    n = np.maximum(counts, 1e-9)
    return np.array([math.log(n[1] / n[0])]) if classes == 2 else np.log(n / n.sum())


def fit_many(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Setting], classes: int = 2,
             part: str | None = None) -> tuple[DataFrame, list[Boosted], list[int]]:
    """Fit all settings together.

    Gives the scored cells (run, rounds, part, y, w, probability) at every number of rounds asked for, the fitted
    runs, and the run of each setting.  Labels are 0 to ``classes`` - 1; rows without label or part are left out.
    """
    spark = df.sparkSession
    ship_code(spark)
    features = list(features)
    runs = list(dict.fromkeys(replace(s, rounds=0) for s in settings))
    run_of = [runs.index(replace(s, rounds=0)) for s in settings]
    marks = sorted({s.rounds for s in settings})
    asked = {m: sorted({r for r, s in zip(run_of, settings) if s.rounds == m}) for m in marks}
    last = [max(s.rounds for s, r in zip(settings, run_of) if r == k) for k in range(len(runs))]
    width, wide = (1 if classes == 2 else classes), len(features)
    tracks = len(runs) * width

    cuts = fit_bins(df, features)
    cells = cut_lineage(cells_of(df, features, label, part, cuts))
    by_part = {(r["part"], r["y"]): (r["w"], r["c"]) for r in cells.groupBy("part", "y").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("c")).collect()}
    rows_of = [np.array([sum(w for (p, y), (w, _) in by_part.items() if y == k and p != s.held) for k in range(classes)], dtype=float) for s in runs]
    cells_in = [sum(c for (p, _), (_, c) in by_part.items() if p != s.held) for s in runs]
    bases = [_base(n, classes) for n in rows_of]
    models = [Boosted(features, cuts, classes, b, []) for b in bases]
    count = sum(c for _, c in by_part.values())
    if 0 < count <= LOCAL:
        # So few cells make one block, and a run needs no pass: runs go side by side instead of round by round.
        state = cut_lineage(_pack(cells, np.zeros(1), wide, 1))
        return _fit_whole_runs(state, models, runs, asked, last, classes, wide), models, run_of
    partitions = max(1, min(-(-count // PART_CELLS), 64 * shuffle_width(spark)))
    state = cut_lineage(_pack(cells, np.concatenate(bases), wide, partitions))
    answers_on = max(1, min(8 * tracks, shuffle_width(spark)))
    scored, since = None, []

    for t in range(marks[-1]):
        growing = {r * width + k: Growing(runs[r], (0.0, 0.0, rows_of[r].sum(), float(cells_in[r])))
                   for r in range(len(runs)) if t < last[r] for k in range(width)}
        while wanted := {i: g.wanted for i, g in growing.items() if g.wanted}:
            plan: Plan = {i: (growing[i].tree.packed(), [(n, growing[i].stats[n][3] <= LOCAL) for n in nodes]) for i, nodes in wanted.items()}
            pieces = state.mapInArrow(_pieces(plan, since, runs, classes, wide), _PIECE)
            told = pieces.repartition(answers_on, "tree", "node").mapInArrow(_answers(runs, width, wide), _SPLIT).toArrow().to_pylist()
            found: dict[int, dict[int, Split]] = defaultdict(dict)
            for r in told:
                if r["feature"] < 0:
                    growing[r["tree"]].stats[1] = tuple(r["stats"])
                    continue
                found[r["tree"]][r["node"]] = Split(
                    r["feature"], r["cut"], r["missing_left"], r["gain"], tuple(r["stats"][:_CHANNELS]), tuple(r["stats"][_CHANNELS:]))
            for i, nodes in wanted.items():
                growing[i].learn(found[i], nodes, [n for n, local in plan[i][1] if local])
        trees = {i: g.close().packed() for i, g in growing.items()}
        for r in {i // width for i in trees}:
            models[r].rounds.append([trees[r * width + k] for k in range(width)])
        since.append(trees)
        if t + 1 in asked or len(since) == CUT_EVERY:
            state, since = cut_lineage(state.mapInArrow(_updated(since, wide, tracks), _BLOCK)), []
        if t + 1 in asked:
            told = state.mapInArrow(_scored(runs, asked[t + 1], classes, wide, t + 1), _SCORED)
            scored = told if scored is None else scored.unionByName(told)
    return scored, models, run_of


def fit(df: DataFrame, features: Sequence[str], label: str, setting: Setting, classes: int = 2) -> Boosted:
    """One setting on all rows of ``df``."""
    return fit_many(df, features, label, [setting], classes)[1][0]
