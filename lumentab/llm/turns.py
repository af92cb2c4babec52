"""Conversation repair: turns aligned with the alternating grammar ``(s?(ua)+)?`` at the least cost.

1. Each conversation becomes a light record of its turns: the role's initial, the fault, the turn number and a
   digest of role and text.  Records are sorted by conversation and turn, and streamed; texts stay behind.
2. Wagner-Fischer over suffixes: ``E[i][r]`` is the cost of aligning the turns from ``i`` on with the last ``r``
   letters of the alternating string, so one table holds every feasible length; a second one holds the strings
   that begin with ``s``.
3. Ukkonen bands: a greedy repair gives an incumbent cost ``c``.  A cell whose remaining lengths differ by ``d``
   costs at least 3 d (insertions) or 4 d (deletions) from there on, so cells beyond c / 3 and c / 4 cannot lie
   on a cheapest path and are never computed.
4. Every feasible length of least cost is traced back, the smallest initial first, and the audits are compared.
5. The texts, sorted once the same way, stream past the audits; the repaired conversation is hashed as it passes.

A conversation is sequential (its audit is one value and its hash one stream), so one task passes over it; it
holds a byte a turn and a digest per distinct turn, never the texts.  Where the band would need more than
``CELLS`` cells, the same costs are taken over the four states of the grammar, turn by turn, with equal results.

Defined results: a null role, text, conversation or turn counts as one space (in the digest of the damage too); a
role other than system, user, assistant goes by its first character; rows of one turn are taken by role, then by
the SHA-256 of role and text; repeated rows are duplicates; rows with a null conversation form one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lumentab.llm.words import tidy
from lumentab.session import cut_lineage, shuffle_width

# Costs of the edits; a truncated turn that stays adds FIX.
REROLE, INSERT, DELETE, FIX = 3, 3, 4, 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Cells of the two tables of one conversation.
CELLS = 1 << 23
_FAR = 1 << 40
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
# The damage by the remainder of the checksum.
DROPPED, EMPTIED, CUT, REPEATED, AS_USER = range(5)


def damaged(rows: DataFrame, every: int = 20) -> DataFrame:
    """(conv_id, turn, role, text, copy) after the damage; a dropped row stays as a mark with copy -1 and no text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % every
    copies = F.when(F.col("kind") == DROPPED, F.array(F.lit(-1))).when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1)))
    text = F.when(F.col("kind").isin(DROPPED, EMPTIED), "").when(F.col("kind") == CUT, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text"), kind.alias("kind"),
    ).select(
        "conv_id", "turn", F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), F.explode(copies.otherwise(F.array(F.lit(0)))).alias("copy"))


def _mark() -> Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _by_conversation(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Whole conversations one after the other; ``absent`` tells the null one from conversation 0."""
    keyed = rows.withColumns({"absent": F.col("conv_id").isNull(), "conv": F.coalesce("conv_id", F.lit(0))})
    dealt = keyed.repartition(shuffle_width(rows.sparkSession), "absent", "conv")
    return dealt.sortWithinPartitions("absent", "conv", *order)


# Ascending order has nulls first.
_TURN_ORDER = ("turn", "role", "mark", "copy")


# ---------------------------------------------------------------- one conversation

def greedy_cost(initials: str, faults: bytes) -> int:
    """The cost of some repair: keep or rerole every turn that may stay, and close the last pair."""
    cost, last = 0, ""
    for c, fault in zip(initials, faults):
        if fault in (BLANK, DUPLICATE):
            cost += DELETE
            continue
        want = "a" if last == "u" else "u"
        if c == "s" and not last:
            last = "s"
        else:
            cost += 0 if c == want else REROLE
            last = want
        cost += FIX * (fault == TRUNCATED)
    return cost + {"u": INSERT, "s": 2 * INSERT}.get(last, 0)


def tables(initials: str, faults: bytes, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``E`` and ``T`` in band form and the band's lower width: column d + low is r = (n - i) + d at row i."""
    # One more below, as the strings with an s are a letter longer than r.
    n, low, high = len(initials), bound // DELETE + 1, bound // INSERT
    d = np.arange(-low, high + 1, dtype=np.int64)
    e = np.full((n + 1, len(d)), _FAR, dtype=np.int64)
    t = np.full((n + 1, len(d)), _FAR, dtype=np.int64)
    e[n] = np.where(d >= 0, INSERT * d, _FAR)
    step = INSERT * d
    odd = (d & 1).astype(bool)
    for i in range(n - 1, -1, -1):
        r = d + (n - i)
        fix = FIX * (faults[i] == TRUNCATED)
        e[i, :-1] = e[i + 1, 1:] + DELETE
        t[i, :-1] = t[i + 1, 1:] + DELETE
        if faults[i] not in (BLANK, DUPLICATE):
            # The next letter is a where r is odd, else u.
            is_a = odd ^ bool((n - i) & 1)
            right = is_a if initials[i] == "a" else ~is_a if initials[i] == "u" else np.zeros(len(d), bool)
            np.minimum(e[i], np.where(r > 0, e[i + 1] + fix + np.where(right, 0, REROLE), _FAR), out=e[i])
            if initials[i] == "s":
                np.minimum(t[i, :-1], e[i + 1, 1:] + fix, out=t[i, :-1])
        e[i, r < 0] = _FAR
        e[i] = np.minimum.accumulate(e[i] - step) + step
        e[i, r < 0] = _FAR
    return e, t, low


def _trace(initials: str, faults: bytes, e: np.ndarray, t: np.ndarray, low: int, r: int, system: bool) -> str:
    """The ASCII-least audit of the alignment with ``r`` letters, behind an s if ``system``."""
    n, i, out, width = len(initials), 0, [], e.shape[1]

    def at(table: np.ndarray, i: int, r: int) -> int:
        k = r - (n - i) + low
        return int(table[i, k]) if r >= 0 and 0 <= k < width else _FAR

    while i < n or r > 0 or system:
        here = at(t if system else e, i, r)
        stays = i < n and faults[i] not in (BLANK, DUPLICATE)
        fix = FIX * (i < n and faults[i] == TRUNCATED)
        if i < n and at(t if system else e, i + 1, r) + DELETE == here:
            out.append("D")
            i += 1
        elif system:
            assert stays and initials[i] == "s" and at(e, i + 1, r) + fix == here
            out.append("K")
            i, system = i + 1, False
        elif r > 0 and at(e, i, r - 1) + INSERT == here:
            out.append("I")
            r -= 1
        else:
            kept = initials[i] == ("a" if r & 1 else "u")
            assert stays and at(e, i + 1, r - 1) + fix + (0 if kept else REROLE) == here
            out.append("K" if kept else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def by_states(initials: str, faults: bytes) -> tuple[int, str]:
    """The same cost and audit over the states of the grammar (nothing yet, s, u, a), in memory of the turns' order."""
    after = (2, 2, 3, 2)  # the state behind the next inserted turn
    word = ("u", "u", "a", "u")
    costs = np.empty((len(initials) + 1, 4), dtype=np.int64)

    def moves(i: int, q: int, nxt) -> Iterator[tuple[str, int, int]]:
        fix = FIX * (faults[i] == TRUNCATED)
        yield "D", q, DELETE + int(nxt[q])
        if faults[i] not in (BLANK, DUPLICATE):
            if q == 0 and initials[i] == "s":
                yield "K", 1, fix + int(nxt[1])
            kept = initials[i] == word[q]
            yield "K" if kept else "R", after[q], fix + (0 if kept else REROLE) + int(nxt[after[q]])

    costs[-1] = (0, 2 * INSERT, INSERT, 0)
    for i in range(len(initials) - 1, -1, -1):
        row = [min(c for *_, c in moves(i, q, costs[i + 1])) for q in range(4)]
        for _ in range(3):
            row = [min(row[q], INSERT + row[after[q]]) for q in range(4)]
        costs[i] = row
    i, q, out = 0, 0, []
    while i < len(initials) or q in (1, 2):
        options = [("I", i, after[q], INSERT + int(costs[i][after[q]]))]
        if i < len(initials):
            options += [(m, i + 1, to, c) for m, to, c in moves(i, q, costs[i + 1])]
        letter, i, q, _ = min(o for o in options if o[3] == costs[i][q])
        out.append(letter)
    return int(costs[0][0]), "".join(out)


def repair(initials: str, faults: bytes) -> tuple[int, str]:
    """The least cost and the audit of a conversation given by initials and faults, one each per turn."""
    n, bound = len(initials), greedy_cost(initials, faults)
    if 2 * (n + 1) * (bound // DELETE + bound // INSERT + 1) > CELLS:
        return by_states(initials, faults)
    e, t, low = tables(initials, faults, bound)
    feasible = [(int(c), k - low + n, system) for table, system in ((e, False), (t, True)) for k, c in enumerate(table[0])
                if c <= bound and (k - low + n) % 2 == 0 and k - low + n >= 2 * system]
    cost = min(c for c, *_ in feasible)
    return cost, min(_trace(initials, faults, e, t, low, r, system) for c, r, system in feasible if c == cost)


# ---------------------------------------------------------------- whole conversations in a stream

_HEAD = StructType([StructField("conv_id", LongType()), *(StructField(c, LongType(), False) for c in _COUNTS), StructField("audit", StringType(), False)])
# The widest conversations of the driver's tables have some hundred turns.
_SHORT = 12


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation of rows (conv_id, absent, conv, turn, copy, initial, blank, whole, mark)."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])
    known: dict[tuple[str, bytes], tuple[int, str]] = {}
    out: list[tuple] = []
    for _, own in groupby(_rows(batches), key=lambda r: r[1:3]):
        initials, faults, seen, turns = [], bytearray(), set(), set()
        conv = None
        for conv, _, _, turn, copy, initial, blank, whole, mark in own:
            if copy < 0:
                continue
            faults.append(BLANK if blank else DUPLICATE if mark in seen else FINE if whole else TRUNCATED)
            seen.add(mark)
            initials.append(initial or "\0")
            if turn is not None:
                turns.add(turn)
        word = "".join(initials)
        record = (word, bytes(faults))
        if record in known:
            found = known[record]
        else:
            found = repair(*record)
            if len(word) <= _SHORT and len(known) < 4096:
                known[record] = found
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(word, word[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, *found))
        if len(out) == 1000:
            yield _flush(out, schema)
            out = []
    if out:
        yield _flush(out, schema)


def edited(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) of the repaired conversation."""
    last = ""
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(turns)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        yield role, text


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads (copy -2) with the digest of their repaired conversation; the rows of a conversation follow its head."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    out: list[tuple] = []
    for _, own in groupby(_rows(batches), key=lambda r: r[1:3]):
        head = next(own)[5:5 + len(_COUNTS) + 1]
        conv = None
        digest, first = hashlib.sha256(), True

        def turns() -> Iterator[tuple[str, str]]:
            nonlocal conv
            for row in own:
                conv = row[0]
                if row[3] >= 0:
                    yield row[4], row[-1]

        stream = turns()
        for role, text in edited(head[-1], stream):
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        for _ in stream:
            pass
        out.append((conv, *head, digest.hexdigest()))
        if len(out) == 1000:
            yield _flush(out, schema)
            out = []
    if out:
        yield _flush(out, schema)


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, counts, cost, audit) of damaged rows."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    light = rows.select(
        "conv_id", "turn", "role", "copy", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("whole"), _mark().alias("mark"))
    dealt = _by_conversation(light, *_TURN_ORDER)
    return dealt.select("conv_id", "absent", "conv", "turn", "copy", "initial", "blank", "whole", "mark").mapInArrow(tidy(_audit), _HEAD)


def repaired(conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conversations`` (conv_id, turn, role, text): faults, cost, audit and digest after damage and repair."""
    rows = damaged(conversations)
    heads = cut_lineage(audits(rows))
    names = [*_COUNTS, "audit"]
    told = heads.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("mark"),
                        F.lit(-2).alias("copy"), *names, F.lit("").alias("text"))
    texts = rows.select("conv_id", "turn", "role", _mark().alias("mark"), "copy",
                        *[F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in names], "text")
    # A head comes first; marks of dropped rows may stand anywhere.
    dealt = _by_conversation(told.unionByName(texts), F.col("copy") > -2, *_TURN_ORDER)
    schema = StructType([*_HEAD.fields, StructField("repaired_sha256", StringType(), False)])
    return dealt.select("conv_id", "absent", "conv", "copy", "role", *names, "text").mapInArrow(tidy(_hash), schema)
