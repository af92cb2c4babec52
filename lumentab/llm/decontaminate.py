"""Benchmark decontamination with training suffix arrays.

The texts of a batch are cut into shards of a few MB.  A shard becomes a sequence of word numbers (0 for a
word that no benchmark item has) whose suffixes are sorted by prefix doubling; runs of numbers that are
shorter than every window cannot hold a match and are left out before sorting.  Every suffix that starts a
window of a benchmark item is binary-searched in each shard, which gives the range of its places.  Windows
that follow each other on a diagonal join into the longest verbatim matches.

The benchmark is a stated query set: it is read in blocks of ``ITEM_BLOCK`` bytes of text, each block is
broadcast (so a broadcast never exceeds that size) and runs against all documents.  Documents are not
shuffled.  Words are compared by 64-bit fingerprints; a false hit needs every word of a window to collide.

Defined results: null texts and texts without word characters have no words; an item without words has no
window; an item without id marks words but is not listed; repeated rows are answered row by row; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from lumentab.llm.words import ALNUM, LOWER, Cut, blocks, spare_name, text_buffers, tidy, with_columns

WINDOW = 10
#: Bytes of benchmark text searched at a time.
ITEM_BLOCK = 8 << 20


@dataclass
class Probe:
    """The windows of a block of benchmark items as sequences of word numbers 1..V."""

    vocabulary: np.ndarray
    words: np.ndarray
    at: np.ndarray
    width: np.ndarray
    #: For each distinct window its (item index, word position) pairs.
    places: list[list[tuple[int, int]]]
    item_ids: list[str | None]


def build_probe(items: list[tuple[object, str | None]], window: int = WINDOW) -> Probe:
    buf, offsets = text_buffers(pa.array([t for _, t in items], pa.string()))
    cut = Cut(buf, offsets, ALNUM)
    vocabulary, words = np.unique(cut.fingerprints(LOWER), return_inverse=True)
    words = words.astype(np.int64) + 1
    places: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for k in range(len(items)):
        lo, hi = int(cut.first[k]), int(cut.first[k + 1])
        if hi > lo:
            width = min(window, hi - lo)
            for p in range(lo, hi - width + 1):
                places[words[p:p + width].tobytes()].append((k, p - lo))
    at = np.array([cut.first[v[0][0]] + v[0][1] for v in places.values()], dtype=np.int64)
    width = np.array([len(k) // 8 for k in places], dtype=np.int64)
    return Probe(vocabulary, words, at, width, list(places.values()), [None if i is None else str(i) for i, _ in items])


def probes(benchmark: DataFrame, item: str, text: str, window: int, block: int = ITEM_BLOCK) -> Iterator[Broadcast]:
    """One broadcast per block of items; an empty benchmark gives one empty block."""
    sc = benchmark.sparkSession.sparkContext
    held: list[tuple[object, str | None]] = []
    size = 0
    for row in benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).toLocalIterator():
        held.append((row.i, row.t))
        size += len(row.t or "")
        if size >= block:
            yield sc.broadcast(build_probe(held, window))
            held, size = [], 0
    if held or size == 0:
        yield sc.broadcast(build_probe(held, window))


class Shard:
    """The suffix array of the documents of a block, to the depth of the widest window."""

    def __init__(self, cut: Cut, probe: Probe):
        self.probe, self.rows = probe, len(cut.offsets) - 1
        marks = cut.fingerprints(LOWER)
        found = np.minimum(np.searchsorted(probe.vocabulary, marks), len(probe.vocabulary) - 1)
        numbers = np.where(probe.vocabulary[found] == marks, found + 1, 0)
        # A zero after each document keeps matches inside it.
        self.row_start = cut.first[:-1] + np.arange(self.rows)
        sequence = np.zeros(len(cut) + self.rows, dtype=np.int64)
        sequence[np.arange(len(cut)) + cut.row] = numbers
        filled = np.concatenate(([False], sequence > 0, [False]))
        start = np.flatnonzero(filled[1:] & ~filled[:-1])
        end = np.flatnonzero(~filled[1:] & filled[:-1])
        long = end - start >= int(probe.width.min())
        step = np.zeros(len(sequence) + 1, dtype=np.int64)
        step[start[long]] += 1
        step[end[long]] -= 1
        sequence[np.cumsum(step[:-1]) == 0] = 0
        self.suffixes = np.flatnonzero(sequence)
        # As many numbers as fit are packed into one key.
        self.bits = max(1, int(len(probe.vocabulary)).bit_length())
        self.per_key = 62 // self.bits
        self.keys = self._packed(sequence)
        self._sort(len(sequence), int(probe.width.max()))

    def _packed(self, sequence: np.ndarray) -> np.ndarray:
        padded = np.concatenate((sequence, np.zeros(self.per_key, dtype=np.int64)))
        keys = np.zeros(len(sequence), dtype=np.int64)
        for k in range(self.per_key):
            keys <<= self.bits
            keys |= padded[k:k + len(sequence)]
        return keys

    def _sort(self, size: int, depth: int) -> None:
        rank = np.zeros(size + 1, dtype=np.int64)
        key, reach = self.keys[self.suffixes], self.per_key
        while True:
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([1], (np.diff(key[order]) != 0).astype(np.int64))) if len(order) else order
            self.suffixes = self.suffixes[order]
            rank[self.suffixes] = np.cumsum(new)
            if reach >= depth or not len(order) or new.all():
                return
            top = rank[self.suffixes[-1]] + 1
            key = rank[self.suffixes] * top + rank[np.minimum(self.suffixes + reach, size)]
            reach *= 2

    def _key(self, ranks: np.ndarray, skip: int, shift: int) -> np.ndarray:
        at = self.suffixes[ranks] + skip
        return np.where(at < len(self.keys), self.keys[np.minimum(at, len(self.keys) - 1)], 0) >> shift

    def _bound(self, lo: np.ndarray, hi: np.ndarray, skip: int, shift: int, wanted: np.ndarray, after: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            middle = (lo[open_] + hi[open_]) // 2
            key = self._key(middle, skip, shift)
            right = key <= wanted[open_] if after else key < wanted[open_]
            lo[open_[right]] = middle[right] + 1
            hi[open_[~right]] = middle[~right]
        return lo

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, place in the sequence) of every occurrence of every window."""
        probe = self.probe
        windows, places = [], []
        keys = self._packed(probe.words)
        for width in np.unique(probe.width):
            which = np.flatnonzero(probe.width == width)
            lo, hi = np.zeros(len(which), dtype=np.int64), np.full(len(which), len(self.suffixes), dtype=np.int64)
            for skip in range(0, int(width), self.per_key):
                shift = self.bits * max(0, self.per_key - (int(width) - skip))
                wanted = keys[probe.at[which] + skip] >> shift
                lo, hi = self._bound(lo, hi, skip, shift, wanted, False), self._bound(lo, hi, skip, shift, wanted, True)
            count = hi - lo
            windows.append(np.repeat(which, count))
            first = np.cumsum(count) - count
            places.append(self.suffixes[np.arange(count.sum()) - np.repeat(first, count) + np.repeat(lo, count)])
        return np.concatenate(windows), np.concatenate(places)


def search_block(cut: Cut, probe: Probe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, row, word) of every occurrence; words count through the block."""
    if not len(probe.places) or not len(cut):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty
    shard = Shard(cut, probe)
    window, place = shard.search()
    row = np.searchsorted(shard.row_start, place, side="right") - 1
    return window, row, place - row


def _mark(cut: Cut, probe: Probe, seen: list[bytes | None], known: list[list[str]]) -> tuple[list[np.ndarray], list[bytes], list[list[str]]]:
    rows = len(cut.offsets) - 1
    window, row, word = search_block(cut, probe)
    step = np.bincount(word, minlength=len(cut) + 1) - np.bincount(word + probe.width[window], minlength=len(cut) + 1)
    hit = np.cumsum(step[:len(cut)]) > 0
    items: list[set[str]] = [set(k) for k in known]
    for pair in np.unique(row * max(1, len(probe.places)) + window):
        r, w = divmod(int(pair), max(1, len(probe.places)))
        items[r].update(i for k, _ in probe.places[w] if (i := probe.item_ids[k]) is not None)
    masks = []
    for r in range(rows):
        lo, hi = cut.first[r], cut.first[r + 1]
        if seen[r]:
            hit[lo:hi] |= np.unpackbits(np.frombuffer(seen[r], np.uint8), count=int(hi - lo)).astype(bool)
        masks.append(np.packbits(hit[lo:hi]).tobytes() if hit[lo:hi].any() else b"")
    return [np.diff(cut.first), np.bincount(cut.row[hit], minlength=rows)], masks, [sorted(s) for s in items]


def _pass(docs: DataFrame, probe: Broadcast, text: str, names: dict[str, str]) -> DataFrame:
    """One block of items against all documents; marks of earlier blocks are kept."""
    later = names["hits"] in docs.columns

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        buf, offsets = text_buffers(columns[text])
        n = len(offsets) - 1
        seen = columns[names["hits"]].to_pylist() if later else [None] * n
        known = columns[names["items"]].to_pylist() if later else [[]] * n
        counts, hits, items = [], [], []
        for lo, hi in blocks(offsets):
            c, m, i = _mark(Cut(buf, offsets[lo:hi + 1], ALNUM), probe.value, seen[lo:hi], known[lo:hi])
            counts.append(c)
            hits += m
            items += i
        longs = [pa.array(np.concatenate([c[k] for c in counts]) if counts else [], pa.int64()) for k in (0, 1)]
        return [*longs, pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))]

    fresh = {k: spare_name(docs, v) for k, v in names.items()} if later else names
    out = with_columns(docs, run, [
        StructField(fresh["n_words"], LongType(), False), StructField(fresh["n_hit"], LongType(), False),
        StructField(fresh["hits"], BinaryType(), False), StructField(fresh["items"], ArrayType(StringType(), False), False)])
    return out.drop(*names.values()).withColumnsRenamed({v: names[k] for k, v in fresh.items()}) if later else out


def mark_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with word count, hit count, hit mask and sorted item ids; and the names of these columns."""
    names = {k: spare_name(docs, k) for k in ("n_words", "n_hit", "hits", "items")}
    for probe in probes(benchmark, item, item_text, window):
        docs = _pass(docs, probe, text, names)
    return docs, names


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: n_words, n_hit, n_items, items_sha256, contaminated, and the item ids."""
    marked, _ = mark_documents(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark, window=window)
    return marked.select(
        F.col("doc_id").alias(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.array_join("items", ",").alias("item_ids"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their columns."""
    marked, names = mark_documents(docs, benchmark, text, window=window)
    return marked.where(F.col(names["n_hit"]) == 0).select(*docs.columns)


MATCH = StructType([
    StructField("doc_id", LongType()), StructField("item_id", StringType()), StructField("doc_word", LongType(), False),
    StructField("item_word", LongType(), False), StructField("n_words", LongType(), False)])


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words): the maximal verbatim matches and where they start."""
    pairs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def found(batches: Iterator[pa.RecordBatch], probe: Probe) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            buf, offsets = text_buffers(batch.column(1))
            out: list[tuple] = []
            for lo, hi in blocks(offsets):
                cut = Cut(buf, offsets[lo:hi + 1], ALNUM)
                starts = sorted(
                    (k, int(r), int(w - cut.first[r]) - p, p, int(probe.width[v]))
                    for v, r, w in zip(*search_block(cut, probe), strict=True) for k, p in probe.places[v])
                run: list[int] | None = None
                for k, r, diagonal, p, width in [*starts, (-1, -1, 0, 0, 0)]:
                    if run and run[:3] == [k, r, diagonal] and p <= run[4] - width + 1:
                        run[4] = p + width
                        continue
                    if run:
                        out.append((ids[lo + run[1]], probe.item_ids[run[0]], run[2] + run[3], run[3], run[4] - run[3]))
                    run = [k, r, diagonal, p, p + width]
            arrays = [pa.array(c, t) for c, t in zip(
                zip(*out, strict=True) if out else [[]] * 5, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=MATCH.names)

    result = None
    for probe in probes(benchmark, "item_id", "text", window):
        part = pairs.mapInArrow(tidy(lambda batches, probe=probe: found(batches, probe.value)), MATCH)
        result = part if result is None else result.unionByName(part)
    return result
