"""Token files with directly addressable codes.

An id is split into chunks of ``CHUNK`` bits, lowest first.  Level k holds the k-th chunks of the ids that have
one; a bitmap says which of them go on, and the rank of a set bit is the entry's place on the next level.  A
directory with the number of set bits before every 64 makes the rank one look-up and one bit count, so any token
is read with one step per level and no block is decoded.

A token file is a Parquet table whose rows are blocks of whole documents in ascending doc_id order: ``part`` (a
range of doc_ids), ``block``, ``first`` (ids of the part before the block), ``n_ids``, ``doc_ids``, ``sizes`` and
``codes``.  Spark's writer commits it, so lost executors leave no half files, and any store Spark reaches will do.
``codes``: "DAC1", uint32 chunk bits, uint32 levels; per level uint64 entries, then the chunks (one byte each), the
bitmap (uint64 words) and the directory (uint32 per word), each padded to 8 bytes.  All little-endian.

Defined results: a null text is empty and gets the end id only; rows without doc_id come first; equal doc_ids
follow each other in the order of their texts' hashes; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumentab.llm.pieces import KIND, PieceTable
from lumentab.llm.store import shared_folder
from lumentab.llm.words import blocks, text_buffers, tidy

CHUNK = 8
MAGIC = b"DAC1"
END = 2
#: Ids from which a block is closed at the end of a document.
BLOCK_IDS = 1 << 18


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def encode(ids: np.ndarray) -> bytes:
    """The codes of a sequence of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >= (1 << CHUNK)
        bits = np.packbits(more, bitorder="little").tobytes()
        words = np.frombuffer(_padded(bits), dtype="<u8")
        counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        directory = np.concatenate(([0], counts[:-1])).astype("<u4") if len(words) else np.empty(0, "<u4")
        levels.append(np.array([len(rest)], "<u8").tobytes() + _padded((rest & ((1 << CHUNK) - 1)).astype(np.uint8).tobytes())
                      + words.tobytes() + _padded(directory.tobytes()))
        rest = rest[more] >> CHUNK
        if not len(rest):
            break
    return _padded(MAGIC + np.array([CHUNK, len(levels)], "<u4").tobytes()) + b"".join(levels)


class Codes:
    """Random access to the ids of one block."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of codes")
        self.bits, depth = (int(x) for x in np.frombuffer(data, "<u4", 2, 4))
        self.levels, at = [], 16
        for _ in range(depth):
            n = int(np.frombuffer(data, "<u8", 1, at)[0])
            words = -(-n // 64)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n + -n % 8
            bitmap = np.frombuffer(data, "<u8", words, at)
            at += 8 * words
            directory = np.frombuffer(data, "<u4", words, at)
            at += 4 * words + -(4 * words) % 8
            self.levels.append((chunks, bitmap, directory))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before entry i of a level."""
        chunks, bitmap, directory = self.levels[level]
        if i >> 6 >= len(bitmap):
            return int(directory[-1]) + int(bitmap[-1]).bit_count() if len(bitmap) else 0
        return int(directory[i >> 6]) + (int(bitmap[i >> 6]) & ((1 << (i & 63)) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        """One id, in one step per level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        out = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            out |= int(chunks[i]) << (self.bits * level)
            if not int(bitmap[i >> 6]) >> (i & 63) & 1:
                break
            i = self._rank(level, i)
        return out

    def read(self, lo: int, hi: int, level: int = 0) -> np.ndarray:
        """The ids lo to hi; their higher chunks stand side by side on the next level."""
        chunks, bitmap, _ = self.levels[level]
        out = chunks[lo:hi].astype(np.uint32)
        if level + 1 < len(self.levels) and hi > lo:
            word = lo >> 6
            flags = np.unpackbits(bitmap[word:(hi + 63) >> 6].view(np.uint8), bitorder="little")[lo - (word << 6):hi - (word << 6)]
            above = self.read(self._rank(level, lo), self._rank(level, hi), level + 1)
            out[flags.astype(bool)] |= above << np.uint32(self.bits)
        return out


def write_tokens(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", end: int = END, path: str | None = None) -> None:
    """Encode the texts and write them to ``folder`` in ascending ``key`` order."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, number = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([h[1] for h in held])
            own = pa.concat_arrays([h[0] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.array(sizes, pa.int64())),
                pa.array([encode(ids)], pa.binary())], names=["part", "block", "first", "n_ids", "doc_ids", "sizes", "codes"])

        for batch in batches:
            buf, offsets = text_buffers(batch.column(1))
            for lo, hi in blocks(offsets):
                ids, sizes = PieceTable.of(path).encode(buf, offsets[lo:hi + 1], end)
                held.append((batch.column(0).slice(lo, hi - lo), ids, sizes))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield close()
                    first, number, held, size = first + size, number + 1, [], 0
        if held:
            yield close()

    schema = "part int, block int, first long, n_ids long, doc_ids array<long>, sizes array<long>, codes binary"
    ordered.mapInArrow(tidy(run, KIND), schema).write.parquet(folder)


def _part_starts(files: DataFrame) -> dict[int, int]:
    """Ids of the file before each part; there are as many as partitions that wrote it."""
    totals = dict(files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, at = {}, 0
    for part in sorted(totals):
        before[part], at = at, at + totals[part]
    return before


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token) of a table of positions in a token file; -1 beyond its end and for null.

    Positions meet blocks on stretches of ``BLOCK_IDS`` ids, by the blocks' numbers alone.  Then only the blocks that hold
    a position are read, and of these only the entries asked for are decoded, one step per level.
    """
    files = spark.read.parquet(folder)
    before = _part_starts(files)
    wanted = positions.select(F.col(position).cast("long").alias("position")).distinct()
    if not before:
        return wanted.select("position", F.lit(-1).cast("long").alias("token"))
    starts = F.create_map(*[F.lit(v) for k, n in before.items() for v in (k, n)])
    spans = files.select("part", "block", (starts[F.col("part")] + F.col("first")).cast("long").alias("start"), "n_ids")
    stretch = lambda c: F.floor(c / BLOCK_IDS).cast("long")
    last = F.col("start") + F.col("n_ids") - 1
    spread = spans.where("n_ids > 0").withColumn("at", F.explode(F.sequence(stretch(F.col("start")), stretch(last))))
    met = wanted.withColumn("at", stretch(F.col("position"))).join(spread, "at").where(
        (F.col("position") >= F.col("start")) & (F.col("position") <= last)).select("part", "block", "position", (F.col("position") - F.col("start")).alias("i"))
    asked = met.groupBy("part", "block").agg(F.sort_array(F.collect_list(F.struct("i", "position"))).alias("asked"))
    held = files.select("part", "block", "codes").join(asked, ["part", "block"]).select("codes", "asked.i", "asked.position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = Codes(batch.column(0)[k].as_buffer().to_pybytes())
                tokens = [codes[i] for i in batch.column(1)[k].as_py()]
                yield pa.RecordBatch.from_arrays([batch.column(2)[k].values, pa.array(tokens, pa.int64())], names=["position", "token"])

    found = held.mapInArrow(tidy(run), "position long, token long")
    return wanted.join(found, "position", "left").select("position", F.coalesce("token", F.lit(-1)).alias("token"))


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of a token file."""
    files = spark.read.parquet(folder)
    before = _part_starts(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for k in range(batch.num_rows):
                codes = Codes(columns["codes"][k].as_buffer().to_pybytes())
                sizes = columns["sizes"][k].values.to_numpy()
                ends = np.cumsum(sizes)
                ids = codes.read(0, len(codes)).astype("<u4")
                sums = [zlib.crc32(ids[e - s:e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                start = before[columns["part"][k].as_py()] + columns["first"][k].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays([
                    columns["doc_ids"][k].values, pa.array(start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    names=[key, "start", "n_tokens", "ids_crc32"])

    return files.select("part", "first", "doc_ids", "sizes", "codes").mapInArrow(
        tidy(run), f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def token_file(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write the token file (to a new shared folder unless one is named) and read its documents back."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    write_tokens(docs, folder, key, text, path=path)
    return read_documents(spark, folder, key)
