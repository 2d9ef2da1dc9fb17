"""Column statistics: count, null_count, mean, std, min, quartiles and max.

Quartiles are exact elements at rank round(q * (n - 1)), half away from zero. One mergeable sketch
per column first brackets each quartile, and equal values inside the brackets are counted together. A
bracket with more than RANKED different values is narrowed: a sketch of its values cuts it into CELLS
cells, the rows of each are counted, and the cell that holds the rank is the next bracket. Only then values
are ranked, RANKED at most in a task, however many a key has. If a bracket ever missed its rank, all are
made wider and counted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.functions.numbers import nan
from jouleloom.session import written

QUARTILES = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
ACCURACY = 10_000  # sketch rank error is n / ACCURACY
MARGIN = 0.0005  # bracket half-width in rank fraction, five times that error
SMALL = 8_192  # up to this many values all of them are counted
RANKED = 65_536  # different values that one task ranks at most
CELLS = 64  # into which a bracket with more of them is cut
STATISTICS = ("count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_columns(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and column, with the nine statistics of numbers.

    If there are text or boolean columns, all rows have min_text and max_text, too; such columns have these
    two and the counts, and no other statistic.
    """
    keys = list(keys)
    named = {f.name: f.dataType for f in df.schema.fields if f.name not in keys}
    wanted = list(named) if columns is None else list(columns)
    numbers = [c for c in wanted if isinstance(named[c], T.NumericType)]
    texts = [c for c in wanted if isinstance(named[c], (T.StringType, T.BooleanType))]
    group = keys or ["all~"]
    rows = df if keys else df.withColumn("all~", F.lit(0))
    described = _described_numbers(rows, group, numbers) if numbers else None
    if texts:
        other = _described_texts(rows, group, texts)
        described = other if described is None else described.unionByName(other, allowMissingColumns=True)
    if described is None:
        raise ValueError("no column to describe")
    return described.select(*keys, *[c for c in described.columns if c not in group])


def _described_numbers(rows: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    rows = rows.select(
        *[F.col(f"`{k}`") for k in group], *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    )
    margin = MARGIN
    while True:
        # Written once, used twice below; its size decides whether the second pass broadcasts it.
        stats = written(_stats(rows, group, columns, margin), "column-stats")
        counted = written(_counted(rows, stats, group, columns), "column-values")
        targets = written(_targets(counted, group), "column-targets")
        if targets.where("outside").isEmpty():
            break
        margin *= 8
    ranked = _quartiles(values_at_ranks(counted.where("not outside"), targets, [*group, "metric", "zone"]), group)
    narrow = stats.select(*group, F.inline(F.array(*[_stat_row(c) for c in columns])))
    result = narrow.join(ranked, [*group, "metric"], "left")
    return result.select(*group, "metric", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _described_texts(rows: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Counts, first and last value, from one aggregation."""
    none = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    aggs = []
    for c in columns:
        v = F.col(f"`{c}`")
        found = F.count(v).alias("count"), F.count_if(v.isNull()).alias("null_count")
        ends = F.min(v).cast("string").alias("min_text"), F.max(v).cast("string").alias("max_text")
        aggs.append(F.struct(F.lit(c).alias("metric"), *found, *none, *ends).alias(f"text~{c}"))
    per_key = rows.groupBy(*[F.col(f"`{k}`") for k in group]).agg(*aggs)
    return per_key.select(*group, F.inline(F.array(*[F.col(f"`text~{c}`") for c in columns])))


def _stats(rows: DataFrame, group: list[str], columns: Sequence[str], margin: float) -> DataFrame:
    probes = [p for _, q in QUARTILES for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    aggs = []
    for c in columns:
        v = F.col(f"`{c}`")
        number = F.when(~F.isnan(v), v)
        for name, agg in {
            "count": F.count(v),
            "nulls": F.count_if(v.isNull()),
            "mean": F.avg(v),
            "std": F.stddev_samp(v),
            "min": F.coalesce(F.min(number), F.min(v)),
            "max": F.coalesce(F.max(number), F.max(v)),
            # The sketch sees NaN as infinity; both ends of the order agree.
            "probe": F.percentile_approx(F.nanvl(v, F.lit(float("inf"))), probes, ACCURACY),
        }.items():
            aggs.append(agg.alias(f"{name}~{c}"))
    return rows.groupBy(*[F.col(f"`{k}`") for k in group]).agg(*aggs)


def _stat_row(c: str) -> Column:
    names = {"count": "count", "nulls": "null_count", "mean": "mean", "std": "std", "min": "min", "max": "max"}
    return F.struct(F.lit(c).alias("metric"), *[F.col(f"`{n}~{c}`").alias(out) for n, out in names.items()])


def _counted(rows: DataFrame, stats: DataFrame, group: list[str], columns: Sequence[str]) -> DataFrame:
    """Counts of equal values; everything between two brackets is one row."""
    kept = [f"`{n}~{c}`" for c in columns for n in ("count", "probe")]
    marked = rows.join(stats.select(*group, *kept), group)
    points = [
        F.struct(
            F.lit(c).alias("metric"),
            F.col(f"`{c}`").alias("v"),
            F.col(f"`count~{c}`").alias("n"),
            F.col(f"`probe~{c}`").alias("probe"),
        )
        for c in columns
    ]
    values = marked.select(*group, F.inline(F.array(*points))).where(F.col("v").isNotNull())
    return (
        values.select(*group, "metric", "n", *_bracketed())
        .groupBy(*group, "metric", "zone", "v", "outside")
        .agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    )


def _targets(counted: DataFrame, group: list[str]) -> DataFrame:
    """Per quartile the zone it lies in, its rank there, and how many different values the zone has."""
    by = [*group, "metric"]
    zones = counted.groupBy(*by, "zone").agg(
        F.max("n").alias("n"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("values"), F.max("outside").alias("outside")
    )
    # A column has a row for each bracket and each space between two.
    before = Window.partitionBy(*[F.col(f"`{k}`") for k in by]).orderBy("zone").rowsBetween(Window.unboundedPreceding, -1)
    placed = zones.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    # floor(x + 0.5) rounds half away from zero, as ranks are not negative
    wanted = [F.struct(F.lit(name).alias("name"), F.floor(F.lit(q) * (F.col("n") - 1) + 0.5).alias("rank")) for name, q in QUARTILES]
    each = placed.select(*by, "zone", "rows", "values", "outside", "before", F.inline(F.array(*wanted)))
    here = each.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows")))
    return here.select(*by, "zone", "name", (F.col("rank") - F.col("before")).alias("rank"), "values", "outside")


def values_at_ranks(values: DataFrame, targets: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """(`keys`, name, v): the value at a rank, from 0, among the values of a key.

    `values` has one row per key and different value v, with `rows` that have it; `targets` has the keys, a name, the
    rank and how many different `values` the key has. Both are read several times: hand in written tables. No
    task ranks more than `limit` values.
    """
    limit, keys = limit or RANKED, list(keys)
    by = [*keys, "name"]
    open_ = targets.select(*by, "rank", "values", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    # All ranks of a key are looked up together, so that its values are moved and sorted once.
    together = F.min("name").alias("part"), F.collect_list(F.struct("name", "rank")).alias("wanted"), F.min("low").alias("low"), F.min("high").alias("high")
    done = open_.where(F.col("values") <= limit).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*together)
    while True:
        wide = open_.where(F.col("values") > limit)
        if wide.isEmpty():
            return _ranked(_within(values, done, keys).drop("low", "high"), [*keys, "part"])
        open_ = written(_narrowed(_within(values, wide, keys), by), "value-ranges")
        small = open_.where(F.col("values") <= limit)
        done = done.unionByName(small.select(*keys, F.col("name").alias("part"), F.array(F.struct("name", "rank")).alias("wanted"), "low", "high"))


def _within(values: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values of every target between its bounds, which are values, too."""
    met = values.select(*keys, "v", "rows").join(targets.drop("values"), list(keys))
    # NaN is above all other values, in comparisons as in the order.
    return met.where(F.col("low").isNull() | ((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high"))))


def _narrowed(values: DataFrame, by: list[str]) -> DataFrame:
    """For every target the cell of its values that holds the rank."""
    grid = [i / CELLS for i in range(1, CELLS)]
    named = [F.col(f"`{k}`") for k in by]
    finite = F.when(F.isnan("v"), float("inf")).otherwise(F.col("v"))
    cuts = written(values.groupBy(*named).agg(F.percentile_approx(finite, grid, ACCURACY).alias("cuts")), "value-cuts")
    cell = F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("cell")
    cells = values.join(cuts, by).groupBy(*named, "rank", cell).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("values"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    before = Window.partitionBy(*named).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # CELLS rows
    placed = cells.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows"))
    return placed.where(here).select(*named, (F.col("rank") - F.col("before")).alias("rank"), "values", "low", "high")


def _ranked(values: DataFrame, by: list[str]) -> DataFrame:
    """The values at the ranks that are `wanted` of every part of a key, all of whose values are ranked."""
    placed = values.withColumn("upto", F.sum("rows").over(Window.partitionBy(*[F.col(f"`{k}`") for k in by]).orderBy("v")))
    here = F.filter("wanted", lambda w: (F.col("upto") > w["rank"]) & (F.col("upto") - F.col("rows") <= w["rank"]))
    return placed.select(*by, "v", F.inline(here)).drop("part", "rank")


def _quartiles(found: DataFrame, group: list[str]) -> DataFrame:
    """One row per column, the quartiles side by side."""
    picks = [F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name, _ in QUARTILES]
    return found.groupBy(*[F.col(f"`{k}`") for k in group], "metric").agg(*picks)


def _bracketed() -> tuple[Column, Column, Column]:
    """(zone, v, outside): inside a bracket the value itself, else the end of the bracket below it.

    Zones are numbered in value order: odd ones are the brackets, even ones lie between them.
    """
    v = F.col("v") + 0.0  # one zero: -0.0 and 0.0 are the same value
    probe, infinite = F.col("probe"), F.lit(float("inf"))
    ends = [(probe[2 * i], probe[2 * i + 1]) for i in range(len(QUARTILES))]
    # An infinite upper end stands for everything above, NaN included.
    ends = [(lo, F.when(hi == infinite, nan()).otherwise(hi)) for lo, hi in ends]
    small = F.col("n") <= SMALL
    zone, below = F.when(small, 1), F.when(small, v)
    for i, (lo, hi) in enumerate(ends):
        under = ends[i - 1][1] if i else F.lit(float("-inf"))
        zone = zone.when(v < lo, 2 * i).when(v <= hi, 2 * i + 1)
        below = below.when(v < lo, under).when(v <= hi, v)
    zone, below = zone.otherwise(2 * len(ends)), below.otherwise(ends[-1][1])
    inside = small
    for lo, hi in ends:
        inside = inside | v.between(lo, hi)
    return zone.alias("zone"), below.alias("v"), (~inside).alias("outside")
