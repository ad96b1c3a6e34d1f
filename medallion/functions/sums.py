"""Sums and averages of doubles that do not depend on the order of the rows.

Adding doubles in another order changes the last digits, so a plain ``sum`` gives
another answer whenever the shuffle, the file split or a retried task differs.  Here every
value is taken apart into limbs, whole numbers on power-of-two grids from 2^88 down to 2^-73:

    x = limb[0] * 2^88 + limb[1] * 2^61 + ... + limb[6] * 2^-73

A limb is what rounding on its grid adds to rounding on the next coarser one.  It has at
most 27 bits, so limbs add up exactly as ``bigint``, and a group may have 2^36 rows before
a sum could overflow (which raises).  The sums are put together once a group.  Every step but
the last rounding is exact; what lies below 2^-73 is left out.  NaN, infinities and values
from 2^103 on have no limbs and are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grid k has steps of 2^-GRIDS[k]; a limb has as many bits as its grid lies below the last one.
GRIDS = (-88, -61, -34, -7, 20, 47, 73)
LIMIT = 2.0**103


def _limbs(column: Column) -> list[Column]:
    """The limbs of a value below the limit, as whole doubles; NULL for a NULL."""
    rounded = [F.rint(column * F.lit(2.0**grid)) for grid in GRIDS]
    finer = zip(rounded[1:], rounded, GRIDS[1:], GRIDS, strict=False)
    return [rounded[0], *(own - coarser * F.lit(2.0 ** (fine - coarse)) for own, coarser, fine, coarse in finer)]


def _whole(parts: list[Column], grids: tuple[int, ...]) -> Column:
    """The sums of some neighbouring grids as one whole number of steps of the finest, as double."""
    wide = [part.cast("decimal(20,0)") * F.lit(2 ** (grids[-1] - grid)).cast("decimal(17,0)") for part, grid in zip(parts, grids, strict=True)]
    total = wide[0]
    for part in wide[1:]:
        total = total + part
    return total.cast("double")


def repeatable_sum(column: Column) -> Column:
    """Sum of a double column as double; NULL when there is no value."""
    usual = F.abs(column) < F.lit(LIMIT)
    sums = [F.sum(limb.cast("bigint")) for limb in _limbs(F.when(usual, column))]
    top, high, low = _whole(sums[:3], GRIDS[:3]), _whole(sums[3:5], GRIDS[3:5]), _whole(sums[5:], GRIDS[5:])
    exact = top * F.lit(2.0**34) + (high / F.lit(2.0**20) + low / F.lit(2.0**73))
    odd = F.sum(F.when(~usual, column))
    return F.coalesce(exact + odd, exact, odd)


def repeatable_avg(column: Column) -> Column:
    """Average of the non-NULL values, NULL when there is none."""
    return F.try_divide(repeatable_sum(column), F.count(column))
