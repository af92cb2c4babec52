"""N-gram Jaccard join: components of documents whose word shingle sets are alike.

1. Every text becomes a sorted set of shingle fingerprints; equal sets form one class (counted by a pair of
   64-bit set fingerprints and the size), so copies cost one row each and no pair.
2. A set sends its prefix to buckets: two sets that link share one of the first n - ceil(t n) + 1 shingles
   under any common order.  The order puts shingles that are frequent in a bounded sample last; that only
   keeps buckets short, links do not depend on it.  A sender carries the logarithm of its size: one that meets no
   other set of like size on a shingle is dropped there, before signatures are added.  Of buckets that the same
   sets send to, one is kept: copies with small changes meet on most of their prefix.
3. A bucket, cut into tiles of about ``TILE`` rows where it is longer, compares its rows in bands of signature
   size: a signature is a parity bitmap with a power of two of bits that follows the set's size, and the bits
   in which two signatures differ are a lower bound of the differing shingles, that is an upper bound of the
   overlap.  Pairs that pass are kept as a spanning forest, at most one edge per row.
4. The components of these edges hold every link.  Each, again in tiles of bounded size, gets the texts of its
   classes, passes the bounds again and decides by sorted-array intersection; pairs that are already connected
   are skipped.  The edges of this forest give the components.  Texts outside components are not shuffled, nor
   are those of the rows that ``keep_one`` returns.

No step holds an unbounded group, emits all pairs of a group or collects rows to the driver.  Fingerprints have
64 bits, so a set of n shingles miscounts with a chance of about n^2 / 2^64.

Defined results: null texts and texts without words have an empty set and link with nothing; repeated rows are
returned one by one; rows that share a doc_id are one document, linked by each of its texts; a row without
doc_id is returned with a null component and links nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from lumentab.llm.runs import whole_groups
from lumentab.llm.words import LOWER, SPACED, Cut, blocks, mix, spare_name, text_buffers, tidy, windows
from lumentab.operators.density import connected_components
from lumentab.operators.ship import joined_with_some, without
from lumentab.session import cut_lineage

SHINGLE = 4
#: Percent: two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Rows of a bucket or component compared at a time are about twice this.
TILE = 512
#: Documents looked at, about, to find frequent shingles, and the number of them that makes one frequent.
SAMPLE, FREQUENT = 4096, 8
#: A sender: the logarithm of its set's size, in steps of 1 / ``SIZE_STEPS``, above the first ``MARK_BITS`` bits of the set's fingerprint.
SIZE_STEPS, MARK_BITS = 256, 50


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle fingerprints of each row."""
    cut = Cut(buf, offsets, SPACED)
    marks = cut.fingerprints(LOWER)
    grams = windows(marks, width)
    out = []
    for r in range(len(offsets) - 1):
        lo, hi = int(cut.first[r]), int(cut.first[r + 1])
        if hi - lo >= width:
            own = np.sort(grams[lo:hi - width + 1])
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif hi > lo:
            out.append(windows(np.concatenate((np.array([hi - lo], np.uint64), marks[lo:hi])), hi - lo + 1))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(own: np.ndarray) -> np.ndarray:
    """Parity bitmap of the smallest power of two of bits not below the set's size, 128 at least.

    With fewer bits unlike sets pass, ever more of them in a larger table, until they hold its components together.
    """
    bits = 1 << max(7, (len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _set_mark(own: np.ndarray) -> np.uint64:
    """The first fingerprint of a set."""
    return mix(own).sum(dtype=np.uint64)


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sender(mark: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Senders of sets with a first fingerprint and a size; in their order sizes ascend."""
    steps = np.floor(SIZE_STEPS * np.log(n)).astype(np.uint64)
    return (steps << np.uint64(MARK_BITS) | mark >> np.uint64(64 - MARK_BITS)).view(np.int64)


def _size_reach(percent: int) -> int:
    """Steps between the sizes of two sets that link, at most."""
    return math.ceil(SIZE_STEPS * math.log(100 / percent)) + 1


def summaries(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, f1, f2, sig) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffers(batch.column(1))
            sets = [s for lo, hi in blocks(offsets) for s in shingle_sets(buf, offsets[lo:hi + 1], width)]
            two = [mix(s ^ np.uint64(0x5851F42D4C957F2D)) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([_set_mark(s) for s in sets], dtype=np.uint64).view(np.int64), pa.int64()),
                pa.array(np.array([m.sum(dtype=np.uint64) for m in two], dtype=np.uint64).view(np.int64), pa.int64()),
                pa.array([signature(s).tobytes() for s in sets], pa.binary())], names=["doc_id", "n", "f1", "f2", "sig"])

    fields = [docs.schema["doc_id"], *(StructField(c, LongType(), False) for c in ("n", "f1", "f2")), StructField("sig", BinaryType(), False)]
    return docs.mapInArrow(tidy(run), StructType(fields))


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles frequent in a sample of about ``SAMPLE`` documents: at most its shingles divided by ``FREQUENT``."""
    step = max(1, docs.count() // SAMPLE)
    sample = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffers(batch.column(1))
            for lo, hi in blocks(offsets):
                own = np.concatenate(shingle_sets(buf, offsets[lo:hi + 1], width) or [np.empty(0, np.uint64)])
                value, count = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count, pa.int64())], names=["s", "c"])

    counted = sample.mapInArrow(tidy(run), "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
    rows = counted.select("s").toArrow().column("s").to_numpy()
    return np.sort(rows.astype(np.int64).view(np.uint64))


def prefixes(docs: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """(sender, key): the prefix shingles of every set of rows (text), once per task for equal sets."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = known.value, set()
        for batch in batches:
            buf, offsets = text_buffers(batch.column(0))
            for lo, hi in blocks(offsets):
                marks, sizes, keys = [], [], []
                for own in shingle_sets(buf, offsets[lo:hi + 1], width):
                    mark = _set_mark(own)
                    if not len(own) or int(mark) in seen:
                        continue
                    seen.add(int(mark))
                    if len(often):
                        late = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
                        own = np.concatenate((own[~late], own[late]))
                    keys.append(own[:_prefix_size(len(own), percent)])
                    marks.append(mark)
                    sizes.append(len(own))
                if keys:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(_sender(np.array(marks, np.uint64), np.array(sizes)), [len(k) for k in keys]), pa.int64()),
                        pa.array(np.concatenate(keys).view(np.int64), pa.int64())], names=["sender", "key"])

    return docs.select("text").mapInArrow(tidy(run), "sender long, key long")


def met_senders(sent: DataFrame, percent: int) -> DataFrame:
    """(bucket, f1_high, c): the senders that share a key with another one of like size, and their number; once for equal buckets."""
    in_order, by_key = Window.partitionBy("key").orderBy("sender"), Window.partitionBy("key")
    beside = {"before": F.lag("sender").over(in_order), "after": F.lead("sender").over(in_order)}
    # Most rows are alone on their key; of the rest, equal sets of several tasks are one sender.
    once = sent.withColumns(beside).where("(before IS NOT NULL OR after IS NOT NULL) AND (before IS NULL OR before < sender)")
    reach = _size_reach(percent)
    like = once.select("key", "sender").withColumns(beside).where(
        f"shiftright(sender, {MARK_BITS}) - shiftright(before, {MARK_BITS}) <= {reach} OR "
        f"shiftright(after, {MARK_BITS}) - shiftright(sender, {MARK_BITS}) <= {reach}")
    told = like.select(
        F.bit_xor(F.xxhash64("sender")).over(by_key).alias("bucket"),
        F.col("sender").bitwiseAND(F.lit((1 << MARK_BITS) - 1)).alias("f1_high"), F.count(F.lit(1)).over(by_key).alias("c"))
    # Dealt by sender, as the join with the signatures needs them.
    return told.repartition("f1_high").distinct()


def _alike(n: np.ndarray, sigs: list[np.ndarray], block: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i, j whose sizes and signatures leave room for a link; only between blocks where these are given."""
    found_i, found_j = [], []
    order = np.argsort(n, kind="stable")
    bits = np.array([len(s) for s in sigs])[order]
    for size in np.unique(bits):
        left = order[bits == size]
        twice = order[bits == 2 * size]
        both = np.concatenate((left, twice))
        own = np.stack([sigs[k] for k in left])
        # A signature of twice the bits folds onto one of this size.
        other = np.concatenate((own, np.stack([sigs[k][:size] ^ sigs[k][size:] for k in twice]))) if len(twice) else own
        step = max(1, (1 << 21) // (len(both) * int(size)))
        for lo in range(0, len(left), step):
            rows = np.arange(lo, min(lo + step, len(left)))
            a, b = n[left[rows]][:, None], n[both][None, :]
            fits = (np.arange(len(both))[None, :] > rows[:, None]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
            if block is not None:
                fits &= block[left[rows]][:, None] != block[both][None, :]
            x, y = np.nonzero(fits)
            if not len(x):
                continue
            apart = np.bitwise_count(own[rows[x]] ^ other[y]).sum(axis=1, dtype=np.int64)
            ok = (100 + percent) * apart <= (100 - percent) * (n[left[rows[x]]] + n[both[y]])
            found_i.append(left[rows[x[ok]]])
            found_j.append(both[y[ok]])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _labels(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row over the pairs."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(nodes: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    off = np.flatnonzero(label != np.arange(len(label)))
    return nodes[off], nodes[label[off]]


def _intersect(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _links(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Labels after exact checks of the pairs, in order, that are not connected yet."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            common = _intersect(sets[x], sets[y])
            if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                parent[max(p, q)] = min(p, q)
    return np.array([root(x) for x in range(len(sets))], dtype=np.int64)


def _tiled(rows: DataFrame, group: str, count: str) -> DataFrame:
    """Rows dealt to tiles (t1, t2) of blocks of about ``TILE`` rows of their group; ``block`` is the row's own."""
    blocks_of = F.ceil(F.col(count) / F.lit(TILE)).cast("int")
    own = rows.withColumn("nb", F.when(F.col(count) > 2 * TILE, blocks_of).otherwise(F.lit(1)))
    own = own.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("nb")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return other.select(
        *[c for c in rows.columns if c != count], "block", F.least("block", "other").alias("t1"),
        F.greatest("block", "other").alias("t2")).repartition(group, "t1", "t2").sortWithinPartitions(group, "t1", "t2", "node")


def _edge_batch(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    b = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _block_of(table: pa.Table, lo: int, hi: int, t1: np.ndarray, t2: np.ndarray, block: np.ndarray) -> np.ndarray | None:
    return block[lo:hi] if t1[lo] != t2[lo] else None


def candidate_edges(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the pairs of each tile that pass the bounds; rows (bucket, node, n, sig, tiles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["bucket", "t1", "t2"]):
            node, n, t1, t2, block = (table.column(c).to_numpy() for c in ("node", "n", "t1", "t2", "block"))
            sigs = table.column("sig").to_pylist()
            size = np.diff(bounds)
            # Most buckets are a pair of sets of unlike size: settled here for the whole table at once.
            two = bounds[:-1][size == 2]
            unlike = 100 * np.minimum(n[two], n[two + 1]) < percent * np.maximum(n[two], n[two + 1])
            settled = np.zeros(table.num_rows, dtype=bool)
            settled[two[unlike]] = True
            parts = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if hi - lo < 2 or settled[lo]:
                    continue
                own = [np.frombuffer(s, np.uint64) for s in sigs[lo:hi]]
                i, j = _alike(n[lo:hi], own, _block_of(table, lo, hi, t1, t2, block), percent)
                if len(i):
                    parts.append(_forest(node[lo:hi], _labels(hi - lo, i, j)))
            yield _edge_batch(parts)

    return buckets.mapInArrow(tidy(run), "a long, b long")


def exact_edges(tiles: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links of each tile; rows (part, node, text, tiles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["part", "t1", "t2"]):
            node, t1, t2, block = (table.column(c).to_numpy() for c in ("node", "t1", "t2", "block"))
            texts = table.column("text").combine_chunks()
            parts = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if hi - lo < 2:
                    continue
                buf, offsets = text_buffers(texts.slice(lo, hi - lo))
                sets = [s for x, y in blocks(offsets) for s in shingle_sets(buf, offsets[x:y + 1], width)]
                n = np.array([len(s) for s in sets], dtype=np.int64)
                i, j = _alike(n, [signature(s) for s in sets], _block_of(table, lo, hi, t1, t2, block), percent)
                if len(i):
                    parts.append(_forest(node[lo:hi], _links(sets, i, j, percent)))
            yield _edge_batch(parts)

    return tiles.mapInArrow(tidy(run), "a long, b long")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component is its smallest doc_id.  ``key`` is an integer."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = cut_lineage(summaries(source, width))
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(known.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"), F.max("sig").alias("sig")))
    shared = met_senders(prefixes(source.where("doc_id IS NOT NULL"), frequent_shingles(source, width), width, percent), percent)
    sets = classes.select("node", "n", "sig", F.shiftrightunsigned("f1", 64 - MARK_BITS).alias("f1_high"))
    buckets = _tiled(shared.join(sets, "f1_high").select("bucket", "node", "n", "sig", "c"), "bucket", "c")
    candidates = cut_lineage(candidate_edges(buckets, percent).distinct())

    # Rows of one doc_id with different texts belong together.
    twofold = known.join(classes.drop("sig"), ["n", "f1", "f2"]).groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b")

    ends = candidates.select(F.col("a").alias("node")).union(candidates.select(F.col("b").alias("node"))).distinct()
    parts = connected_components(ends, candidates).withColumnRenamed("component", "part")
    parts = parts.join(parts.groupBy("part").agg(F.count(F.lit(1)).alias("c")), "part")
    held = joined_with_some(source, "doc_id", cut_lineage(parts), "node").select("part", "node", "text", "c")
    links = cut_lineage(exact_edges(_tiled(held, "part", "c"), width, percent).union(twofold).distinct())

    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    reached = connected_components(ends, links)
    # Components go to the classes first, so that copies are not gathered by their class's node.
    placed = classes.drop("sig").join(reached, "node", "left")
    grouped = rows.join(placed, ["n", "f1", "f2"], "left")
    return grouped.select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id")).alias("_c"),
    ).withColumn("component_id", F.when(F.col(key).isNotNull(), F.col("_c"))).drop("_c")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the document with the smallest id of their component, with their columns.

    Rows without id stay; of rows with the same id one stays.
    """
    out = cut_lineage(jaccard_components(docs, key, text, width, percent).select(F.col(key).alias("id"), "component_id"))
    gone, twice = spare_name(docs, "gone"), spare_name(docs, "twice")
    left = without(docs, key, out.where("component_id < id").select(F.col("id").alias(gone)).distinct(), gone)
    again = out.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias(twice))
    if again.isEmpty():
        return left
    again = cut_lineage(again)
    doubled = joined_with_some(left, key, again, twice).select(*docs.columns)
    return without(left, key, again, twice).unionByName(doubled.dropDuplicates([key]))
