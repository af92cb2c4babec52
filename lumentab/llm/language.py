"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from its code point alone; a trigram is bound as the
product of its letters' vectors, the first rotated twice and the second once; a text bundles (adds up) its
trigrams.  A language's prototype bundles the normalised vectors of its training texts, and a text gets the
language whose prototype has the largest cosine with it.  Letters are those of Unicode in lower case; everything
between two words counts as one space.

A batch's vectors are one product of its trigram counts with the trigram vectors, so no loop runs over letters.
Training reads about ``SAMPLE`` texts of each language, chosen by a hash of their ids (a documented bound for
fitting); prediction reads every text whole.  The prototypes are a few numbers per language; more than
``LANGUAGES`` languages are refused, which bounds what is sent to the executors.

Defined results: ``und`` with score 0 for a null text, a text without letters and an untrained model; equal cosines
go to the first language by name; a row without doc_id counts as held out (the checksum of the empty text is 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from lumentab.llm.words import tidy, with_columns

WIDTH = 1024
SEED = 20_251
SAMPLE = 2000
LANGUAGES = 4096
UNKNOWN = "und"
#: Texts and characters turned into vectors at a time.
ROWS, CHARS = 512, 1 << 20
_SCALE = 4096


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


@lru_cache(maxsize=20_000)
def _letter_vector(code: int) -> np.ndarray:
    return np.random.Generator(np.random.Philox(key=SEED + (code << 32))).integers(0, 2, WIDTH, dtype=np.int8) * 2 - 1


def _trigram_vectors(first: np.ndarray, second: np.ndarray, third: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    letters = np.stack([_letter_vector(int(c)) for c in alphabet])
    bound = np.roll(letters, 2, axis=1)[first]
    bound = bound * np.roll(letters, 1, axis=1)[second]
    bound *= letters[third]
    return bound.astype(np.float32)


def text_vectors(texts: list[str]) -> np.ndarray:
    """One vector per text; zero where a text has no letter."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    out = np.zeros((len(texts), WIDTH), dtype=np.float32)
    # A space before and after each text, and no trigram across two texts.
    space = np.array([0x20], dtype=np.uint32)
    flat = np.concatenate([x for c in codes for x in (space, c, space)]) if codes else space
    row = np.repeat(np.arange(len(texts)), [len(c) + 2 for c in codes])
    letter = _letters()[flat]
    # Of the characters between two words one stays, as the space, and one before the first word.
    kept = letter | np.concatenate(([False], letter[:-1])) | np.concatenate(([True], row[1:] != row[:-1]))
    flat, row, letter = np.where(letter, flat, 0x20)[kept], row[kept], letter[kept]
    if len(flat) < 3:
        return out
    alphabet = np.unique(flat)
    place = np.searchsorted(alphabet, flat)
    a, b, c = place[:-2], place[1:-1], place[2:]
    whole = (row[:-2] == row[2:]) & (letter[:-2] | letter[1:-1] | letter[2:])
    n = len(alphabet)
    gram = (a[whole].astype(np.int64) * n + b[whole]) * n + c[whole]
    grams, which = np.unique(gram, return_inverse=True)
    rows = row[:-2][whole]
    # Distinct trigrams are handled in slices, which bounds the matrices for large alphabets.
    step = 1 << 14
    for lo in range(0, len(grams), step):
        part = grams[lo:lo + step]
        own = (which >= lo) & (which < lo + len(part)) if len(grams) > step else slice(None)
        counts = np.bincount(rows[own] * len(part) + (which[own] - lo), minlength=len(texts) * len(part))
        vectors = _trigram_vectors(part // (n * n), part // n % n, part % n, alphabet)
        out += counts.reshape(len(texts), len(part)).astype(np.float32) @ vectors
    return out


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for k, t in enumerate(texts):
        if k > lo and (k - lo >= ROWS or held + len(t) > CHARS):
            yield lo, k
            lo, held = k, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages by name and their prototypes of length 1, from rows that are not held out."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key)).select(
        F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not known:
        return [], np.empty((0, WIDTH))
    share = F.create_map(*[x for k, n in known.items() for x in (F.lit(k), F.lit(int(min(1.0, sample / n) * (1 << 20))))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                vectors = text_vectors(texts[lo:hi])
                size = np.linalg.norm(vectors, axis=1, keepdims=True)
                # Whole numbers add up to the same sum in any order.
                vectors = np.rint(vectors / np.where(size > 0, size, 1) * _SCALE).astype(np.int64)
                for k, v in zip(langs[lo:hi], vectors, strict=True):
                    total[k] = total[k] + v if k in total else v
        names = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[k].tolist() for k in names], pa.list_(pa.int64()))], names=["lang", "v"])

    sums = (chosen.select("lang", "text").mapInArrow(tidy(run), "lang string, v array<long>")
            .select("lang", F.posexplode("v").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x")).collect())
    names = sorted(known)
    at = {k: n for n, k in enumerate(names)}
    prototypes = np.zeros((len(names), WIDTH))
    for r in sums:
        prototypes[at[r["lang"]], r["d"]] = r["x"]
    size = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return names, prototypes / np.where(size > 0, size, 1)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str, lang_pred: str, score: str) -> DataFrame:
    """``docs`` with the predicted language and its cosine, 0 to 1."""
    names, prototypes = model
    held = docs.sparkSession.sparkContext.broadcast(prototypes.T.astype(np.float32))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
        best, cosine = [], []
        for lo, hi in _slices(texts):
            vectors = text_vectors(texts[lo:hi])
            size = np.linalg.norm(vectors, axis=1)
            if not names:
                best += [UNKNOWN] * (hi - lo)
                cosine.append(np.zeros(hi - lo))
                continue
            near = np.round((vectors @ held.value) / np.where(size > 0, size, 1)[:, None], 6)
            top = near.argmax(axis=1)
            best += [names[k] if s > 0 else UNKNOWN for k, s in zip(top.tolist(), size.tolist(), strict=True)]
            cosine.append(np.where(size > 0, np.clip(near[np.arange(hi - lo), top].astype(np.float64), 0, 1), 0))
        return [pa.array(best, pa.string()), pa.array(np.round(np.concatenate(cosine), 6) if cosine else [], pa.float64())]

    return with_columns(docs, run, [StructField(lang_pred, StringType(), False), StructField(score, DoubleType(), False)])


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """(key, held_out, lang_pred, score): trained on the rows that are not held out, predicted for all."""
    model = train(docs, key, text, lang, sample)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    out = predict(rows, model, "text", "lang_pred", "score")
    return out.select(F.col("doc_id").alias(key), held_out("doc_id").alias("held_out"), "lang_pred", "score")
