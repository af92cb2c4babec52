"""Spelling variants by pivotal grams: words one edit apart, and the frequent form that each rare word leads to.

1. Words are counted with map-side sums.  All letters of a word come from an alphabet of ``LETTERS``, so the
   table of bigram counts has at most ``LETTERS`` squared rows, whatever the corpus.
2. Bigrams are ordered from rare to frequent.  The *prefix* of a word holds its three rarest bigrams (every
   occurrence of a bigram that is no more frequent than the third).  Dynamic programming over the positions
   picks two disjoint *pivots* in the prefix with the least total count.
3. One edit spares one of two disjoint pivots, and a spared pivot of the word whose prefix ends earlier in the
   order lies in the other word's prefix.  So pivots are joined with prefix bigrams, both ways.
4. Position limit: the edit lies either before the second pivot, which then stands as far from the end in both
   words with the same letters after it, or behind the first pivot, with the same letters before it.  The join
   key is the fingerprint of these letters, with the bigram; the lengths differ by one at most.
5. Keys on which more than ``HOT`` pairs would meet (a short beginning or ending that many words share) are
   refined: the edit lies in one half of the letters that the key leaves open, so the other half joins the key.
6. Pairs that meet are verified by their edit distance within the join.

A word has at most 2 * 90 * (length + 1) near words, so no group of the last aggregate grows with the corpus.
Fingerprints have 64 bits; equal ones of different letters only cost a verification.

Defined results: null texts have no words; a null id counts as the empty text in front of the colon; repeated
rows count twice; ties between forms go to the smaller word in code-point order; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumentab.llm.words import mix, tidy
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage

#: Code points of a word, and its occurrences, at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: Bigrams of a prefix: two per allowed edit and one.
PREFIX = 3
#: a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64
#: A form is this many times as frequent as its variant.
TIMES = 10
#: Pairs on a key above which the key is refined; it decides where work is done, not what is found.
HOT = 4096
#: Letters of words worked on at a time.
BLOCK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SIDES = np.array([0x2545F4914F6CDD1D, 0x27D4EB2F165667C5], dtype=np.uint64)


def corpus_words(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 31) -> DataFrame:
    """(word, n): runs of letters, one letter taken out of about one run in ``every``."""
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}})"), F.lit(1)))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, letters as rows of numbers) of words of one length, at most ``BLOCK`` letters at a time."""
    words = np.array(column.to_pylist(), dtype=object)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    for size in np.unique(sizes):
        own = order[np.searchsorted(sizes[order], size):np.searchsorted(sizes[order], size, side="right")]
        step = max(1, BLOCK // int(size))
        for lo in range(0, len(own), step):
            rows = own[lo:lo + step]
            points = np.frombuffer("".join(words[rows]).encode("utf-32-le"), dtype=np.uint32).reshape(len(rows), -1).astype(np.int64)
            yield rows, np.where(points < 128, points - 97, points - 0xC0 + 26)


def _bigrams(letters: np.ndarray) -> np.ndarray:
    return letters[:, :-1] * LETTERS + letters[:, 1:]


def bigram_counts(words: DataFrame) -> np.ndarray:
    """How many distinct words hold each bigram, once per occurrence; as long as the alphabet squared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS * LETTERS, dtype=np.int64)
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                total += np.bincount(_bigrams(letters).ravel(), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["g", "c"])

    out = np.zeros(LETTERS * LETTERS, dtype=np.int64)
    for row in words.select("word").mapInArrow(tidy(run), "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).collect():
        out[row["g"]] = row["c"]
    return out


def prefix_and_pivots(letters: np.ndarray, rank: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of one length: which bigrams are in the prefix, and the places of the first and second pivot."""
    grams = _bigrams(letters)
    order = rank[grams]
    prefix = order <= np.partition(order, PREFIX - 1, axis=1)[:, PREFIX - 1:PREFIX]
    cost = np.where(prefix, weight[grams].astype(float), np.inf)
    # least[:, p]: the cheapest first pivot up to p; a second pivot at p leaves it the places up to p - 2.
    least = np.minimum.accumulate(cost, axis=1)
    second = 2 + np.argmin(cost[:, 2:] + least[:, :-2], axis=1)
    reach = least[np.arange(len(letters)), second - 2]
    return prefix, np.argmax(cost == reach[:, None], axis=1), second


def _side_marks(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the letters up to the end of each bigram, and from its start on."""
    values = letters.astype(np.uint64) + np.uint64(1)
    left, right = np.zeros_like(values), np.zeros_like(values)
    h, back = np.zeros(len(letters), np.uint64), np.zeros(len(letters), np.uint64)
    for k in range(letters.shape[1]):
        h = mix(h * _BASE + values[:, k])
        left[:, k] = h
        back = mix(back * _BASE + values[:, -1 - k])
        right[:, -1 - k] = back
    return left[:, 1:] ^ _SIDES[0], right[:, :-1] ^ _SIDES[1]


def keyed(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """(word, n, size, key, pivot, start, held): the keys of pivots (true) and of prefix bigrams (false) of rows (word, n).

    ``held`` letters of the word are in the key, from its start or from its end.
    """
    order = np.lexsort((np.arange(len(counts)), counts))
    rank = np.empty(len(counts), dtype=np.int64)
    rank[order] = np.arange(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, letters in _by_length(batch.column(0)):
                prefix, first, second = prefix_and_pivots(letters, rank, counts)
                left, right = _side_marks(letters)
                all_rows = np.arange(len(rows))
                r, p = np.nonzero(prefix)
                row = np.concatenate((all_rows, all_rows, r, r))
                key = np.concatenate((left[all_rows, first], right[all_rows, second], left[r, p], right[r, p]))
                start = np.repeat([True, False, True, False], [len(rows), len(rows), len(r), len(r)])
                held = np.concatenate((first + 2, letters.shape[1] - second, p + 2, letters.shape[1] - p))
                took = batch.take(pa.array(rows[row]))
                yield pa.RecordBatch.from_arrays([
                    took.column(0), took.column(1), pa.array(np.full(len(row), letters.shape[1], np.int32)),
                    pa.array(key.view(np.int64)), pa.array(np.arange(len(row)) < 2 * len(rows)), pa.array(start),
                    pa.array(held.astype(np.int32))], names=["word", "n", "size", "key", "pivot", "start", "held"])

    return words.select("word", "n").mapInArrow(
        tidy(run), "word string, n long, size int, key long, pivot boolean, start boolean, held int")


def refined(keys: DataFrame) -> DataFrame:
    """Rows (word, n, size, key, pivot) whose keys also hold one half of the letters left open, for each possible length."""
    open_ = F.col("size") - F.col("held")
    rest = F.when(F.col("start"), F.substring("word", F.col("held") + 1, open_)).otherwise(F.substring("word", F.lit(1), open_))
    # A pivot tells its own length; a prefix bigram meets pivots of words up to one letter shorter or longer.
    sizes = F.when(F.col("pivot"), F.array(F.lit(0))).otherwise(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    told = keys.withColumn("rest", rest).withColumn("open", F.explode(F.transform(sizes, lambda d: open_ + d))).where("open >= 0")
    half = F.floor(F.col("open") / 2).cast("int")
    halves = F.array(
        F.xxhash64("key", "open", F.lit("first"), F.substring("rest", F.lit(1), half)),
        F.xxhash64("key", "open", F.lit("last"), F.right("rest", F.col("open") - half)))
    return told.select("word", "n", "size", F.explode(halves).alias("key"), "pivot")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of words one edit away, and the most frequent of them as (-n, word)."""
    keys = cut_lineage(keyed(words, bigram_counts(words)))
    meet = F.count_if("pivot") * F.count_if(~F.col("pivot"))
    hot = ship_if_short(cut_lineage(keys.groupBy("key").agg(meet.alias("m")).where(F.col("m") > HOT).select("key")))
    cool = keys.join(hot, "key", "left_anti").select("word", "n", "size", "key", "pivot")
    keys = cool.unionByName(refined(keys.join(hot, "key", "left_semi")))
    a = keys.where("pivot").select(*[F.col(c).alias(f"a_{c}") for c in ("word", "n", "size")], "key")
    b = keys.where("NOT pivot").select(*[F.col(c).alias(f"b_{c}") for c in ("word", "n", "size")], "key")
    near = (F.abs(F.col("a_size") - F.col("b_size")) <= 1) & (F.col("a_word") != F.col("b_word")) & (
        F.levenshtein("a_word", "b_word", 1) == 1)
    pairs = a.join(b, "key").where(near)
    both = F.array(
        F.struct(F.col("a_word").alias("word"), F.col("b_word").alias("other"), F.col("b_n").alias("n")),
        F.struct(F.col("b_word").alias("word"), F.col("a_word").alias("other"), F.col("a_n").alias("n")))
    pairs = pairs.select(F.explode(both).alias("p")).select("p.*").distinct()
    return pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "other")).alias("best"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, twice as far in each round."""
    far = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        step = far.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        far = cut_lineage(far.join(step, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root")))
    return far


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus."""
    words = cut_lineage(corpus_words(docs, key, text))
    best = near_words(words)
    form = (-F.col("best.minus")) >= F.col("n") * times
    told = cut_lineage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form, F.col("best.other")).alias("form"), F.when(form, -F.col("best.minus")).alias("form_n")))
    # A form is ``times`` as frequent as its variant, so chains are no longer than this.
    top = words.agg(F.max("n")).first()[0] or 1
    longest = 1 + int(math.log(max(top, 1), times)) if times > 1 else 64
    ends = roots(told.where("form IS NOT NULL"), max(1, math.ceil(math.log2(longest + 1))))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
