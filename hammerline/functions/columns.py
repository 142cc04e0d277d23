"""Small column builders shared by every operator. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return top / F.nullif(bottom, F.lit(0.0))


def like_any(column: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive LIKE over several patterns."""
    return reduce(or_, [column.ilike(p) for p in patterns])


def same_text(column: Column, *values: str) -> Column:
    """Case-insensitive equality with any of the values."""
    return F.lower(column).isin([v.lower() for v in values])


def positive(column: Column) -> Column:
    return F.when(column > 0, column)


def first_positive(columns: Iterable[Column]) -> Column:
    return F.coalesce(*[positive(c) for c in columns])


def all_present(names: Iterable[str]) -> Column:
    return reduce(and_, [F.col(n).isNotNull() for n in names])


def number(column: Column) -> Column:
    """Text to double; anything unreadable, the word NULL included, becomes NULL."""
    return column.cast("string").try_cast("double")


def months_back(as_of, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def same_key(left: str, right: str, names: Iterable[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    return reduce(and_, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])
