"""Mixing sources with a temperature, in DataFrame functions only.

A source's weight is its share of the tokens to the power of an exponent between 0 (all alike) and 1 (as they are).
The exponent is the smallest that keeps every source within a number of repetitions, or the one that meets a target
entropy; it is found by cutting its interval into ``SECTIONS`` again and again, all cuts in one aggregate over the
sources, so sources are never collected.  Without a budget the mixture is as long as it has to be for every document
to appear: the largest source is passed once and no document is lost.

A source's passes are permutations of blocks of its documents (about the square root of their number); the last,
partial pass takes whole blocks in its order and from the block at the border documents in hash order, until the
next would pass the budget.  Block sums and the border block are the only rows that are ordered, so a source with a
third of all documents is no larger a task than its blocks.  What a source gets is one row: passes, border and cut;
documents meet it by a join on the source and are not shuffled while the sources are few.

Tokens are words between white space.  Defined results: rows without source form a source of their own; documents
without words follow their block and weigh nothing; a source without any words is passed once; repeated rows are
taken together or not at all; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumentab.llm.words import spare_name
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage

#: Passes over a source, at most, when no entropy is asked for.
REPEATS = 2.0
SECTIONS, DIGITS = 32, 6
SEED = 20_251


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _facts(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the sum of powered shares and the entropy of the weights."""
    p = F.col("share")
    sums = sources.agg(*[f for k, t in enumerate(exponents) for f in (
        F.sum(F.pow(p, F.lit(t))).alias(f"z{k}"), F.sum(F.pow(p, F.lit(t)) * F.log(p)).alias(f"l{k}"))]).first()
    return [(sums[f"z{k}"], math.log(sums[f"z{k}"]) - t * sums[f"l{k}"] / sums[f"z{k}"]) for k, t in enumerate(exponents)]


def exponent(sources: DataFrame, total: int, budget: float | None, repeats: float | None, entropy: float | None) -> tuple[float, float]:
    """(exponent, tokens of the mixture); ``sources`` has the column share, all above 0."""
    low, high = sources.agg(F.min("share"), F.max("share")).first()

    def tokens(t: float, z: float) -> float:
        return budget if budget is not None else total * z * high ** (1 - t)

    def enough(t: float, z: float, h: float) -> bool:
        """Whether the exponent is large enough; true from some exponent on."""
        # The smallest source is repeated most.
        repeated = tokens(t, z) * low ** (t - 1) / (z * total)
        return (repeats is None or repeated <= repeats + 1e-12) and (entropy is None or h <= entropy)

    lo, hi = 0.0, 1.0
    first = _facts(sources, [0.0, 1.0])
    if enough(0.0, *first[0]):
        return 0.0, tokens(0.0, first[0][0])
    while hi - lo > 10.0 ** -(DIGITS + 1):
        cuts = [lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)]
        good = [t for t, (z, h) in zip(cuts, _facts(sources, cuts), strict=True) if enough(t, z, h)]
        hi = min(good, default=hi)
        lo = max([t for t in cuts if t < hi], default=lo)
    t = min(1.0, math.ceil(round(hi * 10 ** DIGITS, 3)) / 10 ** DIGITS)
    return t, tokens(t, _facts(sources, [t])[0][0])


def _block_key(block: Column, number: Column, source: Column) -> Column:
    """The place of a block in the permutation of a pass: 62 bits."""
    return F.shiftrightunsigned(F.xxhash64(block, number.cast("int"), source, F.lit(SEED)), 2)


def plan(rows: DataFrame, budget: float | None = None, repeats: float | None = REPEATS, entropy: float | None = None) -> DataFrame:
    """One row per source: share, weight, repeats, passes, blocks, border and cut; rows (source, h, n_tokens)."""
    counted = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    counted = cut_lineage(counted.withColumn("blocks", F.ceil(F.sqrt("docs")).cast("long")))
    whole = counted.agg(F.sum("tokens")).first()[0] or 0
    counted = counted.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1))))
    filled = counted.where("tokens > 0")
    if whole:
        t, size = exponent(filled.select("share"), whole, budget, repeats, entropy)
        z = _facts(filled, [t])[0][0]
    else:
        t, size, z = 1.0, 0.0, 1.0
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(t)) / F.lit(z)).otherwise(0.0)
    # Rounded, so that sums in another order give the same passes.
    times = F.when(F.col("tokens") > 0, F.round(weight * F.lit(float(size)) / F.col("tokens"), 9)).otherwise(1.0)
    sources = counted.withColumns({"weight": weight, "exponent": F.lit(t)}).withColumn("repeats", times)
    sources = sources.withColumn("passes", F.floor("repeats").cast("long"))
    sources = sources.withColumn("rest", F.floor((F.col("repeats") - F.col("passes")) * F.col("tokens")).cast("long"))
    sources = cut_lineage(sources)

    # The partial pass: blocks in order up to the budget.
    held = _with_source(rows, sources.where("rest > 0").select("source", "blocks", "passes", "rest"))
    held = held.withColumn("block", F.pmod("h", "blocks"))
    sums = held.groupBy("source", "block", "passes", "rest").agg(F.sum("n_tokens").alias("n"))
    sums = sums.withColumn("at", _block_key(F.col("block"), F.col("passes") + 1, F.col("source")))
    ordered = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("at", "block")))
    border = cut_lineage(ordered.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).select(
        "source", F.col("block").alias("border"), F.col("at").alias("border_at"), (F.col("rest") - (F.col("upto") - F.col("n"))).alias("left")))
    inside = _with_source(held.select("source", "block", "h", "n_tokens"), border).where("block = border")
    inside = inside.groupBy("source", "left", "h").agg(F.sum("n_tokens").alias("n"))
    inside = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("h")))
    cuts = inside.where("upto <= left").groupBy("source").agg(F.max("h").alias("cut"))
    keyed = border.join(cuts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "left")
    return sources.join(keyed.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _with_source(rows: DataFrame, sources: DataFrame, on: str = "source") -> DataFrame:
    """Inner join in which rows without source are a source."""
    few = ship_if_short(sources.withColumnRenamed("source", "_s"))
    return rows.join(few, rows[on].eqNullSafe(few["_s"])).drop("_s")


def _copies(names: dict[str, str], source: str) -> Column:
    """How often a document appears: whole passes, and one more before the border."""
    c = {k: F.col(f"`{v}`") for k, v in names.items()}
    at = _block_key(c["block"], c["passes"] + 1, F.col(source))
    before = (at < c["border_at"]) | ((at == c["border_at"]) & (c["block"] < c["border"]))
    partly = (c["block"] == c["border"]) & (c["h"] <= c["cut"])
    # No border: the partial pass is empty.
    return c["passes"] + F.when(c["rest"] > 0, F.coalesce(before | partly, F.lit(False)).cast("long")).otherwise(0)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", budget: float | None = None,
        repeats: float | None = REPEATS, entropy: float | None = None) -> DataFrame:
    """(key, source, pass, block, n_tokens, mix_key, weight): one row for each time that a document appears.

    Ordered by ``mix_key`` (0 to 1) the rows interleave the sources at their weights, block by block.
    """
    rows = cut_lineage(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(key), F.col(text), F.lit(SEED)).alias("h"), n_tokens(F.col(text)).alias("n_tokens")))
    sources = plan(rows.select("source", "h", "n_tokens"), budget, repeats, entropy)
    placed = _with_source(rows, sources.select("source", "blocks", "passes", "rest", "repeats", "weight", "border", "border_at", "cut"))
    placed = placed.withColumn("block", F.pmod("h", "blocks"))
    shown = placed.withColumn("copies", _copies({c: c for c in ("block", "passes", "border", "border_at", "h", "cut", "rest")}, "source")).where("copies > 0")
    shown = shown.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    share = _block_key(F.col("block"), F.col("pass"), F.col("source")) / F.lit(float(1 << 62))
    return shown.select(
        F.col("doc_id").alias(key), F.col("source").alias(source), "pass", "block", "n_tokens",
        F.round((F.col("pass") - 1 + share) / F.greatest(F.col("repeats"), F.col("pass").cast("double")), 9).alias("mix_key"), F.round("weight", 9).alias("weight"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", budget: float | None = None,
                    repeats: float | None = REPEATS, entropy: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture has it, with their columns."""
    h = F.xxhash64(F.col(key), F.col(text), F.lit(SEED))
    rows = cut_lineage(docs.select(F.col(source).alias("source"), h.alias("h"), n_tokens(F.col(text)).alias("n_tokens")))
    sources = plan(rows, budget, repeats, entropy).select("source", "blocks", "passes", "rest", "border", "border_at", "cut")
    names = {c: spare_name(docs, f"mix_{c}") for c in ("source", "blocks", "passes", "rest", "border", "border_at", "cut", "h", "block", "n")}
    few = ship_if_short(sources.withColumnsRenamed({c: names[c] for c in sources.columns}))
    joined = docs.join(few, docs[source].eqNullSafe(few[names["source"]])).withColumn(names["h"], h)
    joined = joined.withColumn(names["block"], F.pmod(names["h"], names["blocks"]))
    shown = joined.withColumn(names["n"], _copies(names, source)).where(F.col(names["n"]) > 0)
    return shown.withColumn(names["n"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["n"])))).select(*docs.columns)
