"""Electricity prices: nearest-time join, cost, and which blocks cover a time range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jouleloom.keys import JOB
from jouleloom.operators.exact import exact_sum
from jouleloom.session import written

PRICE = "Price_EUR_per_MWh"
EPOCH = "EpochTime"
MONTH_S = 30 * 86_400
J_PER_KWH = 3_600_000.0
J_PER_MWH = 3_600_000_000.0


def price_points(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One price per time: rows without a price dropped, the lowest kept."""
    return points.where(F.col(PRICE).isNotNull()).groupBy(*by, EPOCH).agg(F.min(PRICE).alias(PRICE))


def neighbours(prices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add `before` and `after`: the previous and next time of the same series.

    Two steps keep every window small: inside a calendar block, then over the blocks' edges.
    """
    block = F.floor(F.col(EPOCH) / MONTH_S).alias("block")
    cut = prices.select("*", block)
    keys = [*by, "block"]
    inside = Window.partitionBy(*keys).orderBy(EPOCH)
    edges = cut.groupBy(*keys).agg(F.min(EPOCH).alias("low"), F.max(EPOCH).alias("high"))
    across = Window.partitionBy(*by, F.lit(0)).orderBy("block")
    edges = edges.select(
        *keys, F.lag("high").over(across).alias("high_before"), F.lead("low").over(across).alias("low_after")
    )
    return (
        cut.withColumns({"before": F.lag(EPOCH).over(inside), "after": F.lead(EPOCH).over(inside)})
        .join(edges, keys)
        .select(
            *prices.columns,
            F.coalesce("before", "high_before").alias("before"),
            F.coalesce("after", "low_after").alias("after"),
        )
    )


def price_intervals(prices: DataFrame, by: Sequence[str] = (), bucket_s: int = 86_400) -> DataFrame:
    """Every price with the whole-number interval of times nearest to it, one row per bucket.

    Of two equally near prices the later one owns the time: before + e <= 2x < e + after.
    """
    own = neighbours(prices, by)
    e, before, after = F.col(EPOCH), F.col("before"), F.col("after")
    own = own.select(
        *by,
        e.alias("at~"),
        F.col(PRICE),
        F.coalesce(_half_up(before + e), e).alias("from~"),
        F.coalesce(_half_up(e + after) - 1, e).alias("to~"),
    ).where("`from~` <= `to~`")
    first, last = F.floor(F.col("`from~`") / bucket_s), F.floor(F.col("`to~`") / bucket_s)
    return own.withColumn("bucket~", F.explode(F.sequence(first, last)))


def nearest_prices(
    df: DataFrame, prices: DataFrame, time: str, by: Sequence[str] = (), bucket_s: int = 86_400
) -> DataFrame:
    """Give every row the price whose time is nearest; of two equally near, the later.

    The price intervals, cut into time buckets, turn the range test into an equi-join plus a
    residual comparison. They are written out first, so Catalyst knows their size: it broadcasts
    them if they are small, and otherwise rows meet by bucket and adaptive execution splits crowded
    buckets. Times outside the series move to its first or last point, whose nearest price is the
    same, so no interval is open-ended. `df` itself is never sorted by time.
    """
    by = list(by)
    own = written(price_intervals(prices, by, bucket_s), "price-intervals")
    lowest, highest = F.min("`at~`").alias("lo~"), F.max("`at~`").alias("hi~")
    x, t = F.col("`x~`"), F.col(f"`{time}`")
    if by:
        left = df.join(written(own.groupBy(*by).agg(lowest, highest), "price-ends"), by, "left")
        lo, hi = F.col("`lo~`"), F.col("`hi~`")
    else:
        ends = own.agg(lowest, highest).first()
        left, lo, hi = df, F.lit(ends["lo~"]).cast("bigint"), F.lit(ends["hi~"]).cast("bigint")
    moved = F.when(t.isNotNull() & lo.isNotNull(), F.least(F.greatest(t, lo), hi))
    left = left.withColumn("x~", moved).withColumn("bucket~", F.floor(x / bucket_s))
    joined = left.alias("l").join(
        own.alias("r"),
        _same([*by, "bucket~"]) & F.col("l.`x~`").between(F.col("r.`from~`"), F.col("r.`to~`")),
        "left",
    )
    return joined.select(
        *[F.col(f"l.`{c}`") for c in df.columns],
        F.col("r.`at~`").alias("PriceEpochTime"),
        F.col(f"r.{PRICE}").alias(PRICE),
    )


def _half_up(total: Column) -> Column:
    """Smallest whole x with 2x >= total, without leaving whole numbers."""
    return F.shiftright(total + F.lit(1), 1)


def _same(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & (F.col(f"l.`{c}`") == F.col(f"r.`{c}`"))
    return test


def add_cost(df: DataFrame) -> DataFrame:
    """`Cumulative_cost_EUR`: cumulative kWh times the price at that time.

    The price is per MWh, so the figure is 1000 times an amount in EUR and values all energy at the
    current price. It is kept because users compare with it; see `integrated_cost`.
    """
    return df.withColumn("Cumulative_cost_EUR", F.col("Energy_used_J") / J_PER_KWH * F.col(PRICE))


def job_cost(df: DataFrame) -> DataFrame:
    """Per job the highest cumulative cost, and the cost of each step at its own price in EUR."""
    step = F.col("Energy_Increment_J") / J_PER_MWH * F.col(PRICE)
    return df.groupBy(*JOB).agg(
        F.max("Cumulative_cost_EUR").alias("total_cost_eur"), exact_sum(step).alias("cost_eur_integrated")
    )


def epoch_bounds(df: DataFrame, time: str = EPOCH, by: Sequence[str] = JOB) -> DataFrame:
    """Lowest and highest time and their count; a count of 0 means there is nothing to price."""
    return df.groupBy(*by).agg(
        F.min(time).alias("min_ts"), F.max(time).alias("max_ts"), F.count(time).alias("n")
    )


def price_block_cover(bounds: DataFrame, blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Blocks needed to cover `[min_ts, max_ts]` of every bounds row.

    `bounds` has the `by` columns, min_ts and max_ts; `blocks` has `block`, a start time. Needed
    are the blocks that start inside, the first one at or after min_ts (even if it starts after
    max_ts) and the last one before min_ts. Bounds and blocks meet by calendar month: a block is
    listed under each month from its predecessor's to its successor's, so all three kinds are
    found by an equi-join. Rows are moved to be made distinct only if several bounds have the same `by` columns.
    """
    by = list(by)
    ends = written(
        neighbours(blocks.select(F.col("block").alias(EPOCH)).distinct())
        .withColumnRenamed(EPOCH, "block")
        .withColumn("month", F.explode(F.sequence(_month("before", "block"), _month("after", "block")))),
        "price-blocks",
    )
    edge = ends.agg(F.min("block").alias("low"), F.max("block").alias("high")).first()

    def inside(c: str) -> Column:
        low, high = (F.lit(edge[k]).cast("bigint") for k in ("low", "high"))
        return F.floor(F.least(F.greatest(F.col(c), low), high) / MONTH_S)

    low, high, block = F.col("min_ts"), F.col("max_ts"), F.col("block")
    if edge["low"] is None:
        return bounds.select(*by, F.lit(None).cast("bigint").alias("block")).where("false")
    bounded = written(bounds.where(low.isNotNull()).select(*by, low, high), "price-bounds")
    wanted = bounded.withColumns({"first~": inside("min_ts"), "last~": inside("max_ts")})
    wanted = wanted.withColumn("month", F.explode(F.sequence("first~", "last~")))
    first_at = (block >= low) & (F.col("before").isNull() | (F.col("before") < low))
    last_before = (block < low) & (F.col("after").isNull() | (F.col("after") >= low))
    needed = first_at | last_before | block.between(low, high)
    # A block and bounds that share several months, whichever way these run, meet once: in the first that both have.
    start = F.least("first~", "last~")
    once = F.col("month") == F.greatest(start, _month("before", "block"))
    found = wanted.join(ends, "month").where(needed & once).select(*by, "block")
    several = bounded.groupBy(*by).count().where("count > 1")
    return found if several.isEmpty() else found.distinct()


def _month(column: str, otherwise: str) -> Column:
    return F.floor(F.coalesce(F.col(column), F.col(otherwise)) / MONTH_S)
