"""Sums of doubles that do not depend on how rows are ordered or dealt to tasks.

Adding doubles rounds after every step, so a sum changes in its last digits with the order of rows, and a figure that is
rounded for output can fall on either side. Here every value is cut into whole numbers of a fixed grid, and whole numbers add up exactly in any
order. Columns are summed by built-in aggregates with partial sums before the shuffle; products of whole matrices
(``gram``) are cut the same way and multiplied in double precision, in which whole numbers of bounded size are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is kept from 2**LEAST up to 2**(LEAST + WIDTH * LIMBS); a group may have 2**(63 - WIDTH) rows.
WIDTH, LIMBS, LEAST = 28, 5, -70


def _limbs(x: Column) -> list[Column]:
    """Signed whole numbers, lowest first, of which ``x`` is the sum with weights 2**(LEAST + WIDTH * k)."""
    y = x * F.lit(2.0**-LEAST)  # a power of two: exact
    out = []
    for k in range(LIMBS):
        rest = y if k == LIMBS - 1 else y % F.lit(2.0 ** (WIDTH * (k + 1)))  # the remainder of doubles is exact
        out.append((rest / F.lit(2.0 ** (WIDTH * k))).cast("bigint"))
    return out


def exact_sum(column: Column) -> Column:
    """Aggregate: the sum of a double column, the same for every order of rows; NULL without a value.

    What lies outside the grid (beyond 2**70, infinite, not a number) is summed apart as plain doubles and added. Digits
    under 2**-70 are cut off.
    """
    x = column.cast("double")
    inside = F.abs(x) < F.lit(2.0 ** (LEAST + WIDTH * LIMBS))
    total = F.lit(0.0)
    for k, limb in enumerate(_limbs(F.when(inside, x))):
        total = total + F.coalesce(F.sum(limb), F.lit(0)).cast("double") * F.lit(2.0 ** (LEAST + WIDTH * k))
    apart = F.sum(F.when(~inside, x))
    return F.when(F.count(x) > 0, total + F.coalesce(apart, F.lit(0.0)))


def exact_avg(column: Column) -> Column:
    """Aggregate: the mean of a column, the same for every order of rows."""
    return exact_sum(column) / F.nullif(F.count(column), F.lit(0))


# ---- products of matrices -------------------------------------------------------------------

_GRID = (4, -16, -36)  # exponents of the digits of an entry, which stays under 2**24
_ROWS = 2**12  # rows whose products of digits add up to less than 2**53


def _digits(x: np.ndarray) -> list[np.ndarray]:
    out, rest = [], x
    for e in _GRID:
        d = np.rint(rest * 2.0**-e)
        out.append(d)
        rest = rest - d * 2.0**e
    return out


class Gram:
    """A running sum of a'b over batches of rows, in whole multiples of 2**-52."""

    def __init__(self):
        self.levels = None  # sums of products of digits, with weights 2**8, 2**-12, 2**-32, 2**-52

    def add(self, a: np.ndarray, b: np.ndarray | None = None) -> None:
        for at in range(0, len(a), _ROWS):
            da = _digits(a[at:at + _ROWS])
            db = da if b is None else _digits(b[at:at + _ROWS])
            parts = [da[0].T @ db[0], da[0].T @ db[1] + da[1].T @ db[0], da[0].T @ db[2] + da[1].T @ db[1] + da[2].T @ db[0], da[1].T @ db[2] + da[2].T @ db[1]]
            parts = [p.astype(np.int64) for p in parts]
            self.levels = self._carried(parts if self.levels is None else [s + p for s, p in zip(self.levels, parts, strict=True)])

    @staticmethod
    def _carried(levels: list[np.ndarray]) -> list[np.ndarray]:
        levels = list(levels)
        for k in range(len(levels) - 1, 0, -1):
            carry = (levels[k] + 2**19) >> 20
            levels[k - 1] = levels[k - 1] + carry
            levels[k] = levels[k] - (carry << 20)
        return levels

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """High, middle and low whole numbers, with weights 2**28, 2**-12 and 2**-52; sums of many of each stay exact."""
        top, second, third, last = self.levels
        carry = (top + 2**19) >> 20
        return carry, ((top - (carry << 20)) << 20) + second, (third << 20) + last


def joined(high: Column, middle: Column, low: Column) -> Column:
    """The double that three summed parts of a ``Gram`` stand for.

    What one part holds beyond half a unit of the next is carried first: the same sum comes in other parts when rows are dealt otherwise,
    and would round otherwise.
    """
    def carried(upper: Column, lower: Column) -> tuple[Column, Column]:
        carry = F.shiftright(lower + F.lit(2**39), 40)
        return upper + carry, lower - F.shiftleft(carry, 40)

    middle, low = carried(middle, low)
    high, middle = carried(high, middle)
    return high.cast("double") * F.lit(2.0**28) + (middle.cast("double") * F.lit(2.0**-12) + low.cast("double") * F.lit(2.0**-52))


def scale_of(most: float) -> float:
    """A power of two that brings values up to ``most`` under 2**20, where they keep their leading digits."""
    return 2.0 ** (20 - int(np.frexp(most)[1])) if most > 0 and np.isfinite(most) else 1.0
