"""Columns to rows: the one place that multiplies rows by a list of cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def stack_cells(df: DataFrame, ids: Sequence[str], cells: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row (ids, fields ...) per input row and cell; all cells have the same fields and types.

    Unpivoting structs runs as a generated ``Expand``; exploding an array of structs builds
    that array for every row and takes more than twice as long.
    """
    packed = [F.struct(*[e.alias(n) for n, e in cell.items()]).alias(f"_s{i}") for i, cell in enumerate(cells)]
    names = [f"_s{i}" for i in range(len(cells))]
    return df.select(*ids, *packed).unpivot(list(ids), names, "_which", "_cell").select(*ids, "_cell.*")


def name_of(index: Column | str, names: Sequence[str]) -> Column:
    """Text of a 0-based position in a short list."""
    return F.get(F.array(*[F.lit(n) for n in names]), F.col(index) if isinstance(index, str) else index)
