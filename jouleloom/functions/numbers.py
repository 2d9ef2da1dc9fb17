"""Number helpers as plain column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once, however often `body` uses it.

    Plain column reuse would copy the whole expression into every use.
    """
    return F.transform(F.array(value), body)[0]


def nan() -> Column:
    return F.lit(float("nan"))


def is_finite(c: Column) -> Column:
    """Neither NaN nor infinite. Spark orders NaN above every number, so range tests need this."""
    d = c.cast("double")
    return ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))


def truncate_to_long(c: Column) -> Column:
    """Fraction dropped toward zero; null where the value does not fit, never an ANSI error."""
    return c.try_cast("bigint")


def round_half_even(x: Column, digits: int) -> Column:
    """Round the exact binary value to `digits` decimals, ties to even."""
    return bind(x.cast("double"), lambda v: scaled_half_even(v, F.lit(float(10**digits))))


def scaled_half_even(x: Column, scale: Column) -> Column:
    """Round x to multiples of 1 / scale. Give it plain columns: both are used many times.

    `round`/`bround` work on the shortest decimal text, which moves values such as 2.675 (really
    2.67499...). Here the product with the scale is kept as an unevaluated sum `p + err` (the
    error of the product is found by splitting x in two halves), so the tie test is exact.
    """
    p = x * scale
    big = x * 134217729.0  # 2^27 + 1
    hi = big - (big - x)
    err = (hi * scale - p) + (x - hi) * scale
    f = F.floor(p).cast("double")
    side = ((p - f) - 0.5) + err
    up = (side > 0) | ((side == 0) & (F.pmod(f, F.lit(2.0)) == 1))
    near = (f + F.when(up, 1.0).otherwise(0.0)) / scale
    signed = F.when((near == 0) & (x < 0), -0.0).otherwise(near)
    return F.when(F.abs(p) < 2.0**52, signed).otherwise(x)


def fixed2(x: Column) -> Column:
    """Text with two decimals; not-a-number and infinities in lower case.

    Whole part and fraction are rounded apart, so large numbers keep their exact cents.
    """

    def text(v: Column) -> Column:
        whole = F.floor(F.abs(v))
        cents = F.rint(round_half_even(F.abs(v) - whole.cast("double"), 2) * 100).cast("bigint")
        return bind(
            F.struct(whole.alias("w"), cents.alias("c")),
            lambda t: F.concat(
                F.when(v < 0, "-").otherwise(""),
                (t["w"] + F.floor(t["c"] / 100)).cast("string"),
                F.lit("."),
                F.lpad((t["c"] % 100).cast("string"), 2, "0"),
            ),
        )

    return bind(
        x.cast("double"),
        lambda v: F.when(F.isnan(v), "nan")
        .when(v == float("inf"), "inf")
        .when(v == float("-inf"), "-inf")
        .when(F.abs(v) < 2.0**62, text(v))
        .when(v.isNotNull(), F.format_string("%.2f", v)),
    )


def float_text(x: Column) -> Column:
    """Shortest decimal text of a rounded amount, without an exponent for large values."""
    plain = F.regexp_replace(F.format_string("%.2f", x), "0$", "")
    return F.when(F.abs(x) >= 1e7, plain).otherwise(x.cast("string"))
