"""Samples: datasets in long form, for fleets in which every job may have datasets of its own.

A row is one sample of one dataset: job key, `path` (the dataset's path, whose order is the order of
datasets), `prefix`, `row_idx`, `ElapsedTime` (whole, null if missing or not valid), `bad_time` (a time that
is not valid), `cells` (numbers, with the place and name of their field) and `texts` (text and flags, the same).
Which datasets and fields there are is data: no list of them ever comes to the driver, and a job costs as much
as it has cells, whatever other jobs have. Results are the same as those of stacked frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.numbers import is_finite
from jouleloom.keys import JOB, ROW, SEP, TIME
from jouleloom.operators.columns import ENERGY_NAMES, POWER_NAMES
from jouleloom.operators.frames import Frames, time_is_valid, truncate_time
from jouleloom.operators.scan import scan
from jouleloom.plans.segments import SEGMENT_ROWS, laid_out, special_jobs
from jouleloom.session import written

CELL = "struct<at:int,metric:string,value:double>"
TEXT = "struct<at:int,metric:string,value:string>"
#: Rows between two values that one row of the plan stands for at most.
GAP = 4_096
POSITION = "position"
#: Columns that tell a dataset and a field of it.
DATASET = [*JOB, "path", "prefix"]


def samples_of(frames: Frames, names: dict[str, Column] | None = None) -> DataFrame:
    """Stacked frames in long form; `names` replaces prefixes. Fields that are no numbers become text."""
    rows = truncate_time(frames.with_df(frames.df.withColumn("bad_time", ~time_is_valid(F.col(TIME))))).df
    path, prefix, cells, texts = (F.lit(None) for _ in range(4))
    for n, p in reversed(list(enumerate(frames.prefixes))):
        has = F.col(f"`{p}`").isNotNull()
        numbers, others = [], []
        for at, f in enumerate(frames.fields(p)):
            is_number = f.dataType.typeName() in ("double", "float", "long", "integer", "short", "byte", "decimal")
            value = F.col(f"`{p}`")[f.name].cast("double" if is_number else "string")
            cell = F.struct(F.lit(at).alias("at"), F.lit(f.name).alias("metric"), value.alias("value"))
            (numbers if is_number else others).append(cell)
        path = F.when(has, F.array(F.format_string("%06d", F.lit(n)))).otherwise(path)
        prefix = F.when(has, names[p] if names else F.lit(p)).otherwise(prefix)
        cells = F.when(has, F.array(*numbers).cast(f"array<{CELL}>")).otherwise(cells)
        texts = F.when(has, F.array(*others).cast(f"array<{TEXT}>")).otherwise(texts)
    named = {"path": path.cast("array<string>"), "prefix": prefix.cast("string"), "cells": cells, "texts": texts}
    return rows.select(*JOB, ROW, TIME, "bad_time", *[c.alias(n) for n, c in named.items()])


def cell_value(metric: str) -> Column:
    """The value of a field in a sample, null if there is none."""
    return F.try_element_at(F.filter("cells", lambda c: c["metric"] == metric), F.lit(1))["value"]


def dataset_facts(samples: DataFrame) -> DataFrame:
    """Per dataset: rows, invalid times, whether it has power that sums to zero, and bad epochs if it has any."""
    has_power = F.exists("cells", lambda c: c["metric"] == "NodePower")
    power = F.sum(F.when(has_power, F.coalesce(cell_value("NodePower"), F.lit(0.0))))
    epoch = cell_value("EpochTime")
    return samples.groupBy(*DATASET).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(TIME).alias("t_min"),
        F.max(TIME).alias("t_max"),
        F.count_if("bad_time").alias("bad_rows"),
        F.coalesce(power == 0, F.lit(False)).alias("zero"),
        F.max(F.exists("cells", lambda c: c["metric"] == "EpochTime")).alias("has_epoch"),
        F.count_if(epoch.isNotNull() & ~is_finite(epoch)).alias("bad_epochs"),
    )


def sample_facts(samples: DataFrame) -> DataFrame:
    """`job_facts` of samples: one row per job, with the same columns."""
    told = F.struct("path", "prefix", "rows", "zero", "bad_rows", "has_epoch", "bad_epochs")
    jobs = dataset_facts(samples).groupBy(*JOB).agg(
        F.sum("rows").alias("n_rows"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"), F.array_sort(F.collect_list(told)).alias("sets")
    )
    usable = F.filter("sets", lambda s: ~s["zero"])
    timed = F.filter("usable_sets", lambda s: s["has_epoch"])
    # The Energy dataset first, the others in their order.
    chosen = F.coalesce(F.try_element_at(F.filter(timed, lambda s: s["prefix"] == "Energy"), F.lit(1)), F.try_element_at(timed, F.lit(1)))
    return jobs.withColumn("usable_sets", usable).select(
        *JOB,
        "n_rows",
        "t_min",
        "t_max",
        F.map_from_entries(F.transform("sets", lambda s: F.struct(s["prefix"], s["rows"]))).alias("n"),
        F.transform(F.filter("sets", lambda s: s["zero"]), lambda s: s["prefix"]).alias("zero_power"),
        F.transform("usable_sets", lambda s: s["prefix"]).alias("usable"),
        F.exists("usable_sets", lambda s: s["bad_rows"] > 0).alias("bad_time"),
        F.coalesce(chosen["bad_epochs"] > 0, F.lit(False)).alias("bad_epoch"),
    )


def usable_samples(samples: DataFrame, groups: str = "all") -> DataFrame:
    """Samples of the files, groups and datasets that are used, written; the same rules as for frames."""
    samples = written(samples, "samples")  # made once, read for the facts and for what is used
    facts = written(sample_facts(samples), "sample-facts")
    special = special_jobs(facts, groups, SEGMENT_ROWS).where("skip or size(drop) > 0").drop("long")
    if special.isEmpty():
        return samples
    rows = samples.join(written(special, "special-samples"), JOB, "left").where(~F.coalesce(F.col("skip"), F.lit(False)))
    kept = rows.where(~F.coalesce(F.array_contains("drop", F.col("prefix")), F.lit(False))).drop("skip", "drop")
    return written(kept, "usable-samples")


def timeline_of(samples: DataFrame, limit: int = SEGMENT_ROWS) -> tuple[DataFrame, bool]:
    """(job, ElapsedTime, sets, times, base) of every distinct time of a job, and whether any time has several rows.

    `sets` lists the datasets with rows at that time: how many they have, and how many rows of the later ones'
    product each of them spans. `times` is the product of all, the rows at that time; `base` counts the rows before.
    """
    met = samples.groupBy(*JOB, TIME, "path").agg(F.count(F.lit(1)).alias("n"))
    listed = met.groupBy(*JOB, TIME).agg(F.array_sort(F.collect_list(F.struct("path", "n"))).alias("sets"))
    one = F.lit(1).cast("bigint")

    def span(s: Column, at: Column) -> Column:
        later = F.slice("sets", at + 2, F.size("sets"))
        return F.struct(s["path"].alias("path"), s["n"].alias("n"), F.aggregate(later, one, lambda a, x: a * x["n"]).alias("span"))

    times = F.when(F.col(TIME).isNull(), one).otherwise(F.aggregate("sets", one, lambda a, s: a * s["n"]))
    placed = written(listed.select(*JOB, TIME, times.alias("times"), F.transform("sets", span).alias("sets")), "sample-times")
    parts, order = laid_out(placed, JOB, [TIME], limit)
    summed = scan(parts, order, sums={"upto": "times"})
    timeline = written(summed.select(*JOB, TIME, "sets", "times", (F.col("upto") - F.col("times")).alias("base")), "sample-timeline")
    return timeline, not placed.where("times > 1").isEmpty()


def placed_samples(samples: DataFrame, timeline: DataFrame, repeated: bool) -> DataFrame:
    """Samples with the positions they take in the rows of their job; a sample without a time takes none.

    Where a dataset has several rows at a time, or others have, rows multiply: they are the combinations of
    one row of each dataset, in the order of the first dataset's rows, then of the second's, and so on. So a
    sample takes every position whose digit for its dataset is the sample's number.
    """
    rows = samples.where(F.col(TIME).isNotNull())
    if not repeated:  # all times are different within a dataset, and a time is one row
        return rows.join(timeline.select(*JOB, TIME, F.col("base").alias(POSITION)), [*JOB, TIME])
    parts, order = laid_out(rows, [*DATASET, TIME], [ROW])
    numbered = scan(parts, order, position="k").withColumn("k", F.col("k") - 1)
    met = numbered.join(timeline, [*JOB, TIME])
    own = F.element_at(F.filter("sets", lambda s: s["path"] == F.col("path")), 1)
    met = met.withColumn("own", own).withColumn("step", F.col("own.n") * F.col("own.span"))
    first = F.col("base") + F.col("k") * F.col("own.span")
    start = F.explode(F.sequence(first, F.col("base") + F.col("times") - 1, F.col("step"))).alias("start")
    wide = met.select(*DATASET, ROW, TIME, "cells", "texts", F.col("own.span").alias("span"), start)
    at = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("span") - 1)).alias(POSITION)
    return wide.select(*DATASET, ROW, TIME, "cells", "texts", at)


def interpolated(placed: DataFrame, limit: int = SEGMENT_ROWS) -> DataFrame:
    """(dataset, at, metric, position, value): every number, and the straight line between two of them, by position.

    A field's numbers are scanned, not its rows: each one stands for the rows since the one before it.
    Long stretches are cut into GAP rows and dealt out.
    """
    cells = placed.select(*DATASET, POSITION, F.inline("cells")).where("value IS NOT NULL")
    parts, order = laid_out(cells, [*DATASET, "at", "metric"], [POSITION], limit)
    found = scan(parts, order, lags={"since": POSITION, "old": "value"})
    found = found.withColumn("since", F.coalesce("since", F.col(POSITION) - 1))
    field = [*DATASET, "at", "metric", POSITION, "value", "since", "old"]

    def lines(of: DataFrame, start: Column, stop: Column) -> DataFrame:
        here = F.col("here")
        slope = (F.col("value") - F.col("old")) / (F.col(POSITION) - F.col("since"))
        value = F.when(here == F.col(POSITION), F.col("value")).otherwise(F.col("old") + (here - F.col("since")) * slope)
        each = of.select(*field, F.explode(F.sequence(start, stop)).alias("here"))
        return each.select(*DATASET, "at", "metric", here.alias(POSITION), value.alias("value"))

    if (placed.agg(F.max(POSITION)).first()[0] or 0) <= GAP:  # no stretch of any job is longer
        return lines(found, F.col("since") + 1, F.col(POSITION))
    near = F.col(POSITION) - F.col("since") <= GAP
    short = lines(found.where(near), F.col("since") + 1, F.col(POSITION))
    cuts = F.sequence(F.col("since") + 1, F.col(POSITION), F.lit(GAP).cast("bigint"))
    far = found.where(~near).select(*field, F.explode(cuts).alias("start"))
    far = far.repartition(*[F.col(c) for c in (*JOB, "path", "metric", "start")])
    return short.unionByName(lines(far, F.col("start"), F.least(F.col("start") + GAP - 1, F.col(POSITION))))


def aligned_samples(samples: DataFrame, limit: int = SEGMENT_ROWS, stored: bool = False) -> DataFrame:
    """(job, position, ElapsedTime, values, texts): the rows of every job, from 0, with its numbers and texts by column.

    Columns are named `<prefix>__<field>`. A row holds the columns that have a value there; numbers are
    interpolated by position, and stay open before the first and after the last one. `stored` samples are read from
    a table, as those of `usable_samples`; others are written first.
    """
    if not stored:
        samples = written(samples, "samples")
    timeline, repeated = timeline_of(samples, limit)
    placed = written(placed_samples(samples, timeline, repeated).select(*DATASET, POSITION, "cells", "texts"), "placed-samples")
    rows = timeline.select(*JOB, TIME, F.explode(F.sequence(F.col("base"), F.col("base") + F.col("times") - 1)).alias(POSITION))
    column = F.concat("prefix", F.lit(SEP), "metric")
    entry = F.struct("path", "at", column.alias("column"), "value")
    numbers = interpolated(placed, limit).select(*JOB, POSITION, entry.alias("number"))
    texts = placed.select(*DATASET, POSITION, F.inline("texts")).where("value IS NOT NULL").select(*JOB, POSITION, entry.alias("text"))
    every = rows.unionByName(numbers, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    met = every.groupBy(*JOB, POSITION).agg(F.max(TIME).alias(TIME), F.array_sort(F.collect_list("number")).alias("numbers"), F.array_sort(F.collect_list("text")).alias("texts"))
    return met.select(*JOB, POSITION, TIME, _named("numbers").alias("values"), _named("texts").alias("texts"))


def _named(entries: str) -> Column:
    """A map of columns to values; of equal names the last dataset's counts."""
    names = F.transform(entries, lambda e: e["column"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["column"]))
    last = F.when(F.size(F.array_distinct(names)) == F.size(names), F.col(entries)).otherwise(last)
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["column"], e["value"])))


def job_columns(samples: DataFrame) -> DataFrame:
    """Per job its columns in order, and those of power, metered energy and epoch: the first one of each.

    A column is there if its dataset is, even without a value.
    """
    fields = samples.select(*DATASET, F.explode(F.transform("cells", lambda c: F.struct(c["at"], c["metric"]))).alias("field"))
    known = fields.select(*DATASET, "field.*").distinct().withColumn("column", F.concat("prefix", F.lit(SEP), "metric"))
    jobs = known.groupBy(*JOB).agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "at", "column"))), lambda c: c["column"]).alias("columns"))

    def first(test) -> Column:
        return F.try_element_at(F.filter("columns", test), F.lit(1))

    epoch = F.coalesce(first(lambda c: c == "Energy__EpochTime"), first(lambda c: c.endswith("__EpochTime")))
    return jobs.select(*JOB, "columns", first(_named_like(POWER_NAMES)).alias("power"), first(_named_like(ENERGY_NAMES)).alias("meter"), epoch.alias("epoch"))


def _named_like(names: Sequence[str]):
    def test(column: Column) -> Column:
        found = F.lit(False)
        for n in names:
            found = found | (column == n) | column.endswith(f"{SEP}{n}")
        return found

    return test
