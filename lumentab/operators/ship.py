"""Size-checked broadcast: one rule for every join of rows with a derived short table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A table this small is shipped to every task; a larger one goes through a shuffle join.
SHIP_ROWS, SHIP_BYTES = 100_000, 8 << 20
# Rows with texts or arrays that are fetched before their bytes are measured on the cluster.
FIRST_ROWS = 1000


def _has_long_values(table: DataFrame) -> bool:
    return any(not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in table.schema)


def _is_small(table: DataFrame) -> bool:
    """Whether the rows and the bytes of their texts and arrays stay within the limits; looks at SHIP_ROWS + 1 rows at most."""
    sizes = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
             for f in table.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    row = table.limit(SHIP_ROWS + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(reduce(lambda a, b: a + b, sizes)).alias("b")).first()
    return row["n"] <= SHIP_ROWS and (row["b"] or 0) <= SHIP_BYTES


def ship_if_short(table: DataFrame) -> DataFrame:
    """``table`` as a broadcast constant if it has at most ``SHIP_ROWS`` rows and ``SHIP_BYTES`` bytes, else unchanged.

    The planner cannot know the size of a derived table, so it would shuffle the long side by
    the join key first, hot keys included.  Measuring the short side costs one small job and
    its rows are not computed again.
    """
    head = None
    if _has_long_values(table):
        head = table.limit(FIRST_ROWS + 1).collect()
        if len(head) > FIRST_ROWS:
            head = None
            if not _is_small(table):
                return table
        elif sum(len(str(v)) for r in head for v in r) > SHIP_BYTES:
            return table
    if head is None:
        head = table.limit(SHIP_ROWS + 1).collect()
        if len(head) > SHIP_ROWS:
            return table
    return F.broadcast(table.sparkSession.createDataFrame(head, table.schema))


# A table of bits stands for the keys of a table that is too long to ship: so many bits a key, in words of 64, at most so many words.
KEY_BITS, WORDS = 32, 1 << 20


def _own_columns(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]


def _with_bits(rows: DataFrame, key: str, table: DataFrame, own: str, how: str) -> tuple[DataFrame, str]:
    """``rows`` joined with the shipped bits of the integer keys ``own`` of ``table``, and a condition no row of such a key fails."""
    words = max(1, min(WORDS, -(-table.count() * KEY_BITS // 64)))
    taken = {c.lower() for c in (*rows.columns, *table.columns)}
    word, bits = (next(n for k in range(len(taken) + 1) if (n := f"{'_' * k}{c}") not in taken) for c in ("key_word", "key_bits"))

    def place(column: str) -> str:
        return f"pmod(xxhash64(CAST(`{column}` AS BIGINT)), {64 * words}L)"

    def bit(column: str) -> str:
        return f"shiftleft(1L, CAST({place(column)} % 64 AS INT))"

    known = table.where(F.col(own).isNotNull()).groupBy(F.expr(f"{place(own)} DIV 64").alias(word)).agg(F.bit_or(F.expr(bit(own))).alias(bits))
    return rows.join(F.broadcast(known), F.expr(f"{place(key)} DIV 64") == F.col(word), how), f"(`{bits}` & {bit(key)}) <> 0"


def joined_with_some(rows: DataFrame, key: str, table: DataFrame, own: str) -> DataFrame:
    """Inner join of ``rows`` with ``table`` on integer keys, of which most rows find none: nearly all of these are not shuffled."""
    on = F.col(key) == F.col(own)
    short = ship_if_short(table)
    if short is not table:
        return rows.join(short, on)
    marked, may = _with_bits(rows, key, table, own, "inner")
    return marked.where(may).select(*_own_columns(rows)).join(table, on)


def without(rows: DataFrame, key: str, table: DataFrame, own: str) -> DataFrame:
    """``rows`` whose integer key is not among the keys ``own``, each once, of ``table``; nearly all of these are not shuffled."""
    on = F.col(key) == F.col(own)
    short = ship_if_short(table)
    if short is not table:
        return rows.join(short, on, "left_anti")
    marked, may = _with_bits(rows, key, table, own, "left")
    surely = marked.where(f"NOT coalesce({may}, false)").select(*_own_columns(rows))
    # The planner would put an anti join below the one with the bits, and so shuffle all rows.
    return surely.unionByName(marked.where(may).select(*_own_columns(rows)).join(table.select(own), on, "left").where(F.col(own).isNull()).drop(own))


def join_with_nulls(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join in which a NULL key matches a NULL key, so no row is lost."""
    right = table.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in table.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return rows.join(right, on).drop(*[f"_r_{k}" for k in keys])
