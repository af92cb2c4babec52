"""Column expressions: text clean-up, coercion, guarded arithmetic, binning, vectors.

Every function returns a ``Column`` built from built-in Spark expressions, so it stays
inside whole-stage code generation and never needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Texts that stand for a missing cell in delimited files.
MISSING_TOKENS = ("NA", "N/A", "na", "NaN", "?", "-999", "")

# Frequency answers and their ordinal codes.
LIKERT_CODES = {"Nunca": 1, "Rara vez": 2, "A veces": 3, "Frecuentemente": 4, "Siempre": 5}

# Fixed value: honorific between the comma and the first full stop of a full name.
TITLE_PATTERN = r",\s*([^\.]+)\."


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of every kind (``trim`` knows spaces only)."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+", ""), r"\s+$", "")


def tidy_name(name: str) -> str:
    """Header text on one line without outer blanks."""
    return name.replace("\n", " ").strip()


def null_if_token(c: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """NULL where the stripped text is a missing-value token; a real NULL stays NULL."""
    text = strip(c)
    return F.when(~text.isin(*tokens), text)


def percent_number(c: Column | str) -> Column:
    """``'70%'`` -> 70.0, unparsable text -> NULL."""
    return F.replace(col(c), F.lit("%"), F.lit("")).try_cast("double")


def number_or_null(c: Column | str, dtype: str = "double") -> Column:
    return col(c).try_cast(dtype)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere -- also where an operand is NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def ratio_or_null(a: Column | str, b: Column | str) -> Column:
    """``a / b`` with a zero denominator giving NULL."""
    return col(a) / F.nullif(col(b), F.lit(0.0))


def ratio_offset(a: Column | str, b: Column | str, offset: float = 1e-9) -> Column:
    """``a / (b + offset)``."""
    return col(a) / (col(b) + F.lit(offset))


def lookup(c: Column | str, codes: Mapping, dtype: str = "double") -> Column:
    """Dictionary lookup for a short code list; an unmapped value becomes NULL."""
    value = col(c)
    branches = [F.when(value == F.lit(k), F.lit(v)) for k, v in codes.items()]
    return F.coalesce(*branches).cast(dtype)


def cut(c: Column | str, limits: Sequence[float], labels: Sequence) -> Column:
    """Label of the first limit that is >= the value; the last label above all limits.

    A NULL value falls through every comparison and gets the last label, as a chain of
    ``if`` statements over a missing number does.
    """
    if len(labels) != len(limits) + 1:
        raise ValueError("cut needs one label more than limits")
    value = col(c)
    chain = reduce(
        lambda acc, pair: acc.when(value <= F.lit(pair[0]), F.lit(pair[1])),
        zip(limits[1:], labels[1:-1]),
        F.when(value <= F.lit(limits[0]), F.lit(labels[0])),
    )
    return chain.otherwise(F.lit(labels[-1]))


def title_of(c: Column | str) -> Column:
    found = F.regexp_extract(col(c), TITLE_PATTERN, 1)
    return F.nullif(strip(found), F.lit(""))


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean over the non-NULL cells of a row; NULL when all are NULL."""
    cells = [col(c).cast("double") for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cells])
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cells])
    return total / F.nullif(count, F.lit(0))


def reverse_scored(c: Column | str, top: int = 6) -> Column:
    return F.lit(top) - col(c)


def clip(c: Column | str, low, high) -> Column:
    """Clip to [low, high]; NULL stays NULL although ``greatest``/``least`` skip NULLs."""
    value = col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equally long arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x
    )


def squared_distance_to(cols: Sequence[Column | str], point: Sequence[float]) -> Column:
    """Squared Euclidean distance of scalar coordinate columns to a fixed point."""
    parts = [(col(c) - F.lit(float(p))) * (col(c) - F.lit(float(p))) for c, p in zip(cols, point)]
    return reduce(lambda a, b: a + b, parts)


def unbiased_skewness(c: Column | str) -> Column:
    """Bias-corrected skewness G1 as one aggregate expression; NULL below three values."""
    n = F.count(col(c)).cast("double")
    return F.when(n > 2, F.skewness(col(c)) * F.sqrt(n * (n - 1)) / (n - 2))
