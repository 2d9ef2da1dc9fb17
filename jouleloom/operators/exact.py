"""Sums of broken numbers that do not depend on the order of addition.

A number is cut into whole numbers at fixed places: multiples of 2^31, of 1, of 2^-32 and of 2^-64. These are
added exactly, so that sums of segments, of tasks or of a whole job are the same in every bit; only the end
result is rounded, to one unit in the last place or 2^-53. What lies below 2^-64 is rounded first; numbers from 2^62 on, infinities and NaN are
added as they are. A key can have 2^30 numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMBS = ("high", "whole", "part", "rest", "other")
_WHOLE, _PART = (1 << 31) - 1, (1 << 32) - 1
_SCALE = float(1 << 32)


def limbs(x: Column) -> dict[str, Column]:
    """The parts of a number; null where it is null. Give it a plain column: it is used many times."""
    usual = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**62)
    value = F.when(usual, x)
    whole = value.cast("bigint")
    fraction = (value - whole.cast("double")) * _SCALE
    part = fraction.cast("bigint")
    return {
        "high": F.shiftright(whole, 31),
        "whole": whole.bitwiseAND(F.lit(_WHOLE)),
        "part": part,
        "rest": F.rint((fraction - part.cast("double")) * _SCALE).cast("bigint"),
        "other": F.when(x.isNotNull() & ~usual, x),
    }


def joined(sums: dict[str, Column]) -> Column:
    """The number that sums of parts stand for; null if there is none."""

    def of(name: str) -> Column:
        return F.coalesce(sums[name], F.lit(0).cast("bigint"))

    part = of("part") + F.shiftright(of("rest"), 32)
    whole = of("whole") + F.shiftright(part, 32)
    high = of("high") + F.shiftright(whole, 31)
    small = part.bitwiseAND(F.lit(_PART)).cast("double") / _SCALE + of("rest").bitwiseAND(F.lit(_PART)).cast("double") / _SCALE / _SCALE
    below = whole.bitwiseAND(F.lit(_WHOLE))
    far = high.cast("double") * float(1 << 31) + below.cast("double")
    total = F.when(F.abs(high) < 1 << 31, (F.shiftleft(high, 31) + below).cast("double")).otherwise(far) + small
    return F.when(sums["other"].isNotNull(), sums["other"] + total).otherwise(F.when(sums["high"].isNotNull(), total))


def exact_sum(x: Column) -> Column:
    """The sum of a group, the same in whatever order its rows come."""
    return joined({name: F.sum(part) for name, part in limbs(x.cast("double")).items()})
