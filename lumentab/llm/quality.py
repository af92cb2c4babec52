"""Quality rules with host verdicts.

Every text is measured once; the rules are expressions on the measures.  The failures of each rule are
summed per host, the rates are shrunk with a beta prior fitted to all hosts, and a host whose shrunk rate
passes the limit is strict: its documents have to pass every rule, elsewhere the base rules decide.
A clean document is therefore kept whatever its host is like.

Defined results: a null or empty text has no words and fails the base rule; a document without host is
judged by the base rules alone; repeated rows are judged row by row; an empty table gives an empty table.
Columns that clash with names used here are neither read nor changed.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from lumentab.llm.words import LINES, SPACED, Cut, blocks, mix, spare_name, text_buffers, windows, with_columns
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
#: Bytes of text measured at a time; the arrays of a block take some 40 times as much.
MEASURED_BYTES = 1 << 18
#: Rule name -> condition under which a text fails it; {} is put before the measure names.
RULES = {
    "short": "{n_words} < 20",
    "repeat": "100 * {n_repeat_words} > 30 * {n_words}",
    "symbols": "10 * {n_symbols} > {n_words}",
    "word_size": "{word_chars} > 15 * {n_words} OR {word_chars} < 2 * {n_words}",
    "dup_lines": "20 * {n_dup_lines} > {n_words}",
}
BASE_RULES = ("short", "repeat")
#: Shrunk failure rate from which a host is strict.
HOST_LIMIT = 0.5


def _twins(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys, and for each neighbour pair in that order whether the two are equal."""
    order = np.argsort(key)
    ordered = key[order]
    return order, ordered[1:] == ordered[:-1]


def measure_block(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    words, lines = Cut(buf, offsets, SPACED), Cut(buf, offsets, LINES)
    rows = len(offsets) - 1
    salt = mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))
    chars = words.per_row(words.mask & ((words.bytes & 0xC0) != 0x80))
    symbols = words.per_row(SYMBOLS[words.bytes])

    filled = np.concatenate(([0], np.cumsum(words.mask, dtype=np.int64)))
    has_word = filled[lines.ends] > filled[lines.starts]
    order, same = _twins(lines.fingerprints()[has_word] ^ salt[lines.row[has_word]])
    dup_lines = np.bincount(lines.row[has_word][order[1:][same]], minlength=rows)

    marks = windows(words.fingerprints(), WINDOW)
    covered = np.zeros(len(words), dtype=bool)
    if len(marks):
        whole = np.flatnonzero(words.row[:len(marks)] == words.row[WINDOW - 1:])
        order, same = _twins(marks[whole] ^ salt[words.row[whole]])
        twice = np.zeros(len(words) + 1, dtype=np.int64)
        twice[whole[order[1:][same]]] = 1
        twice[whole[order[:-1][same]]] = 1
        total = np.concatenate(([0], np.cumsum(twice[:-1])))
        at = np.arange(1, len(words) + 1)
        covered = total[at] > total[np.maximum(at - WINDOW, 0)]
    repeated = np.bincount(words.row[covered], minlength=rows)
    return [np.diff(words.first), chars, symbols, dup_lines, repeated]


def measure_texts(column: pa.Array) -> list[pa.Array]:
    """The measures of a column of texts, worked out block by block."""
    buf, offsets = text_buffers(column)
    parts = [measure_block(buf, offsets[lo:hi + 1]) for lo, hi in blocks(offsets, MEASURED_BYTES)]
    return [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], pa.int64()) for k in range(len(MEASURES))]


def measured(docs: DataFrame, names: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with the measures of ``text`` as columns called ``names[measure]``."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return measure_texts(batch.column(batch.schema.names.index(text)))

    return with_columns(docs, run, [StructField(names[m], LongType(), False) for m in MEASURES])


def _fails(rule: str, names: dict[str, str]) -> Column:
    return F.expr(RULES[rule].format(**{m: f"`{c}`" for m, c in names.items()}))


def base_failed(names: dict[str, str]) -> Column:
    return reduce(lambda a, b: a | b, [_fails(r, names) for r in BASE_RULES])


def host_rates(measures: DataFrame, names: dict[str, str], host: str = "source") -> DataFrame:
    """(host, n_docs, <rule>_failed, <rule>_rate): failures and shrunk rates of every host."""
    # Read several times below: the texts behind it are measured once.
    per_host = cut_lineage(measures.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(_fails(r, names).cast("long")).alias(f"{r}_failed") for r in RULES]))
    raw = {r: F.col(f"{r}_failed") / F.col("n_docs") for r in RULES}
    # One row: mean and variance over hosts of each rule's raw rate.
    prior = per_host.agg(*[f(raw[r]).alias(f"{r}_{n}") for r in RULES for n, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    out = {}
    for r in RULES:
        mean, var = prior[f"{r}_mean"] or 0.0, prior[f"{r}_var"] or 0.0
        # Method of moments; rates that do not differ say that one host tells as much as all.
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
        out[f"{r}_rate"] = (F.col(f"{r}_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return per_host.withColumns(out)


def strict_hosts(measures: DataFrame, names: dict[str, str], host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    rates = host_rates(measures, names, host)
    return rates.where(reduce(lambda a, b: a | b, [F.col(f"{r}_rate") >= limit for r in RULES])).select(host)


def _verdict(measures: DataFrame, strict: DataFrame, names: dict[str, str], host: str, kept: str) -> DataFrame:
    mark, key = spare_name(measures, "strict_mark"), spare_name(measures, "strict_host")
    marked = measures.join(
        ship_if_short(strict.select(F.col(host).alias(key), F.lit(True).alias(mark))), F.col(host) == F.col(key), "left")
    fails_any = reduce(lambda a, b: a | b, [_fails(r, names) for r in RULES])
    return marked.withColumn(kept, ~base_failed(names) & ~(F.col(mark).isNotNull() & fails_any)).drop(mark, key)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """(key, host, measures, base_failed, kept) of every row."""
    names = {m: m for m in MEASURES}
    source = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"))
    rows = cut_lineage(measured(source, names).drop("text"))
    verdict = _verdict(rows, strict_hosts(rows, names, limit=limit), names, "source", "kept")
    return verdict.select(F.col("doc_id").alias(key), F.col("source").alias(host), *MEASURES,
                          base_failed(names).alias("base_failed"), "kept")


def filter_documents(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    The texts are measured twice, once for the hosts and once for the rows, instead of being shuffled.
    """
    plain = {m: m for m in MEASURES}
    strict = strict_hosts(measured(docs.select(F.col(host).alias("source"), F.col(text).alias("text")), plain), plain, limit=limit)
    names = {m: spare_name(docs, f"q_{m}") for m in MEASURES}
    kept = spare_name(docs, "q_kept")
    judged = _verdict(measured(docs, names, text), strict.withColumnRenamed("source", host), names, host, kept)
    return judged.where(F.col(kept)).select(*docs.columns)
