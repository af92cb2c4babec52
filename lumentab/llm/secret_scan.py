"""Secret scans with a trigram index, in DataFrame functions only.

Each rule's pattern is read once on the driver and turned into a Boolean trigram query: alternatives of trigrams
that every match must contain, in lower case.  The inverted index holds, for the trigrams that some query asks
for, the texts that contain them; a query's postings are intersected by collecting their trigrams as bits per text
and alternative, and a text is a candidate of a rule if one alternative is complete.  Candidates are verified with
the pattern itself.  Rules without a mandatory trigram look at every text.

Texts are keyed by a 64-bit hash in the index: texts that share one share candidates, never results.  The join
that brings candidates to the texts has one row per key on the index side, so a group of copies is split by the
adaptive planner like any skewed side.

Offsets of matches are code points, from the lengths of the matches and of the text between them, added up in
blocks of the square root of their number so that long texts with many matches stay cheap.

Defined results: a null text counts as empty and has no match; repeated rows are answered one by one.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``group`` (0: all of it) has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The forms of well-known credentials.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

#: Alternatives followed while a pattern is read; beyond it a part counts as unknown text.
BRANCHES = 256

Branch = tuple[frozenset[str], str]


def _add(branches: set[Branch], char: str) -> set[Branch]:
    out = set()
    for grams, tail in branches:
        tail += char.lower()
        out.add((grams | {tail[-3:]} if len(tail) >= 3 else grams, tail[-2:]))
    return out


def _cut(branches: set[Branch]) -> set[Branch]:
    """What follows is unknown: no trigram crosses it."""
    return {(grams, "") for grams, _ in branches}


def _class(members: list) -> list[str] | None:
    """The characters of a small class."""
    out: list[str] = []
    for op, value in members:
        if op is sre.LITERAL:
            out.append(chr(value))
        elif op is sre.RANGE and value[1] - value[0] < 8:
            out += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(parsed: object, branches: set[Branch]) -> set[Branch]:
    for op, value in parsed:
        if op is sre.LITERAL:
            new = _add(branches, chr(value))
        elif op is sre.IN and (chars := _class(value)) is not None:
            new = set().union(*[_add(branches, c) for c in chars])
        elif op is sre.SUBPATTERN:
            new = _walk(value[-1], branches)
        elif op is sre.BRANCH:
            new = set().union(*[_walk(v, branches) for v in value[1]])
        elif op is sre.MAX_REPEAT:
            low, high, inner = value
            new = branches
            for _ in range(min(low, 8)):
                new = _walk(inner, new)
            if (low, high) == (0, 1):
                new = branches | _walk(inner, branches)
            elif low != high or low > 8:
                new = _cut(new)
        else:
            new = _cut(branches)
        branches = new if len(new) <= BRANCHES else _cut(branches)
    return branches


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams one of which every match holds in lower case; None if a match may hold none."""
    found = {grams for grams, _ in _walk(parser.parse(pattern), {(frozenset(), "")})}
    if frozenset() in found:
        return None
    return sorted((g for g in found if not any(o < g for o in found)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(key, gram): the inverted index of ``docs`` (key, text) for these trigrams, by their numbers."""
    lowered = docs.select("key", F.lower("text").alias("low"))
    return lowered.select("key", F.explode(F.array_compact(F.array(
        *[F.when(F.contains("low", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)]))).alias("gram"))


def candidates(docs: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, kinds): the rules whose trigram query a text meets; rows (key, text)."""
    trigrams = sorted({g for q in queries.values() for a in q for g in a})
    at = {g: n for n, g in enumerate(trigrams)}
    # The bits of a long: some of the trigrams that every match holds are a filter as well.
    cut = [(kind, n, sorted(a)[:60]) for kind, q in queries.items() for n, a in enumerate(q)]
    wanted = [(at[g], kind, n, 1 << b, (1 << len(a)) - 1) for kind, n, a in cut for b, g in enumerate(a)]
    # One row per trigram of the rules, whatever the data.
    plan = docs.sparkSession.createDataFrame(wanted, "gram int, kind string, alternative int, bit long, every long")
    met = postings(docs, trigrams).join(F.broadcast(plan), "gram").groupBy("key", "kind", "alternative", "every").agg(
        F.bit_or("bit").alias("bits")).where("bits = every")
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


SPAN = "array<struct<s:bigint,e:bigint>>"


def spans(text: Column, rule: Rule) -> Column:
    """(s, e) of the matches that count."""
    pattern = F.lit(rule.pattern)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m).cast("long"))
    counted = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m) >= rule.least)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p).cast("long"))
    matches = F.zip_with(sizes, counted, lambda m, ok: F.struct(m.alias("m"), ok.alias("ok")))
    # One more gap than matches: the last is dropped with its null partner.
    pairs = F.filter(F.zip_with(gaps, matches, lambda g, x: F.struct(g.alias("g"), x["m"].alias("m"), x["ok"].alias("ok"))), lambda x: x["m"].isNotNull())
    return F.transform(F.filter(_placed(pairs), lambda x: x["ok"]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def _placed(pairs: Column) -> Column:
    """Starts and ends of (g, m, ok): sums within blocks, on top of the sums of the blocks before."""
    item = "array<struct<s:bigint,e:bigint,ok:boolean>>"
    width = F.ceil(F.sqrt(F.size(pairs).cast("double"))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.size(pairs) - 1, F.greatest(width, F.lit(1))), lambda b: F.slice(pairs, b + 1, F.greatest(width, F.lit(1))))
    total = F.transform(cut, lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda a, x: a + x["g"] + x["m"]))
    before = F.aggregate(
        total, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
    inside = F.zip_with(cut, before, lambda block, at: F.aggregate(
        block, F.struct(at.alias("at"), F.array().cast(item).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + x["m"]).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + x["m"]).alias("e"), x["ok"].alias("ok")))).alias("out")))["out"])
    return F.when(F.size(pairs) > 0, F.flatten(inside)).otherwise(F.array().cast(item))


def _joined(found: list[tuple[int, Rule]]) -> Column:
    """kind:start:end of all spans, by start, then rule order."""
    names = F.array(*[F.lit(r.kind) for r in RULES])

    def numbered(n: int, rule: Rule) -> Column:
        return F.transform(F.col(f"f_{rule.kind}"), lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("n"), x["e"].alias("e")))

    every = reduce(lambda a, b: F.concat(a, b), [numbered(n, r) for n, r in found])
    return F.array_join(F.transform(F.array_sort(every), lambda x: F.concat_ws(
        ":", F.element_at(names, x["n"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    queries = {r.kind: q for r in RULES if (q := trigram_query(r.pattern)) is not None}
    keyed = rows.withColumn("key", F.xxhash64("text"))
    found = candidates(keyed.select("key", "text"), queries).withColumnRenamed("key", "known")
    placed = keyed.join(found, F.col("key") == F.col("known"), "left")
    none = F.array().cast(SPAN)
    verified = placed.select("doc_id", *[
        F.when(F.array_contains("kinds", r.kind) if r.kind in queries else F.col("text").rlike(r.pattern), spans(F.col("text"), r)).otherwise(none).alias(f"f_{r.kind}")
        for r in RULES])
    every = list(enumerate(RULES))
    return verified.select(
        F.col("doc_id").alias(key), *[F.size(f"f_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in RULES if r.base],
        F.sha2(_joined([x for x in every if x[1].base]).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"),
        *[F.size(f"f_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in RULES if not r.base])
