"""Job tables of fleets whose jobs have datasets of their own: columns are data, not schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.numbers import truncate_to_long
from jouleloom.keys import JOB, SEP, TIME
from jouleloom.operators.clean import DEFAULT_RULES, clean_cast
from jouleloom.operators.columns import CORES, Derived, derived_figures
from jouleloom.operators.prices import EPOCH
from jouleloom.operators.samples import POSITION, aligned_samples, job_columns, usable_samples
from jouleloom.operators.scan import scan
from jouleloom.plans.jobs import priced
from jouleloom.plans.segments import SEGMENT_ROWS, laid_out
from jouleloom.session import written

#: Columns that every job has, next to `values` and `texts`.
COMMON = [TIME, EPOCH, "NodePower", "ElapsedTime_Diff", "Energy_Increment_J", "Energy_used_J"]


def fleet_profile(samples: DataFrame, groups: str = "all", limit: int = SEGMENT_ROWS) -> DataFrame:
    """The rows of all jobs: job, position, COMMON, whether the job has energy data, values and texts.

    The rules are those of `energy_profile`: the first column of a job that is named as power gives its energy,
    otherwise the first one that is named as energy gives its power.
    """
    used = usable_samples(samples, groups)
    chosen = written(job_columns(used).drop("columns"), "job-columns")
    rows = aligned_samples(used, limit, stored=True).join(chosen, JOB, "left")
    has_power, has_meter = F.col("power").isNotNull(), F.col("power").isNull() & F.col("meter").isNotNull()

    def named(column: str) -> Column:
        return F.try_element_at("values", F.col(column))

    rows = rows.select(
        *JOB, POSITION, TIME, "values", "texts", truncate_to_long(named("epoch")).alias(EPOCH),
        has_power.alias("powered~"), has_meter.alias("metered~"), named("power").alias("power~"), F.when(has_meter, named("meter")).alias("meter~"),
    )
    parts, order = laid_out(written(rows, "fleet-rows"), JOB, [POSITION], limit)
    found = scan(parts, order, lags={"time~": TIME, "old~": "meter~"})
    step = (F.col(TIME) - F.col("`time~`")).cast("double")
    found = found.withColumns({"step~": step, "ElapsedTime_Diff": F.when(F.col("`powered~`"), F.coalesce(step, F.lit(0.0)))})
    found = found.withColumn("added~", F.col("ElapsedTime_Diff") * F.col("`power~`"))
    found = scan(found, order, sums={"total~": "added~"})
    grown = F.coalesce(F.col("`meter~`") - F.col("`old~`"), F.lit(0.0))
    rate = F.when(F.col("`step~`") > 0, grown / F.nullif("`step~`", F.lit(0.0)))

    def either(power: str, meter: Column) -> Column:
        return F.when(F.col("`powered~`"), F.col(f"`{power}`")).when(F.col("`metered~`"), meter)

    found = found.withColumns(
        {
            "NodePower": either("power~", rate),
            "Energy_Increment_J": either("added~", grown),
            "Energy_used_J": either("total~", F.col("`meter~`")),
            "has_energy_data": F.col("`powered~`") | F.col("`metered~`"),
        }
    )
    return found.select(*JOB, POSITION, *COMMON, "has_energy_data", with_derived("values").alias("values"), "texts")


def with_derived(values: str, cores: int = CORES) -> Column:
    """The values and what follows from them: memory in megabytes, utilisation per core."""
    def derived(d: Derived) -> Column:
        own = F.map_filter(values, lambda c, _: c.endswith(SEP + d.source))
        named = F.transform_keys(own, lambda c, _: F.replace(c, F.lit(SEP + d.source), F.lit(SEP + d.name)))
        return F.transform_values(named, lambda _, v: v / d.per)

    return F.map_concat(values, *[derived(d) for d in derived_figures(cores)])


def clean_values(values: str) -> Column:
    """The values that are in the range of their column's rule, rounded as its type would; the others are left out."""

    def cleaned(column: Column, value: Column) -> Column:
        picked = value
        for rule in reversed(DEFAULT_RULES):
            fits = F.lit(False)
            for name in rule.exact:
                fits = fits | (column == name)
            for name in rule.suffix:
                fits = fits | column.endswith(SEP + name)
            keep = (value >= F.lit(rule.low)) & (value < F.lit(float("inf")))
            if rule.high is not None:
                keep = keep & (value <= F.lit(rule.high))
            picked = F.when(fits, F.when(keep, value.try_cast(rule.dtype).cast("double"))).otherwise(picked)
        return picked

    return F.map_filter(F.transform_values(values, cleaned), lambda _, v: v.isNotNull())


def fleet_table(samples: DataFrame, prices: DataFrame | None = None, groups: str = "first", limit: int = SEGMENT_ROWS) -> DataFrame:
    """The cleaned table of every job, by default of a file's first usable group: COMMON, prices, values and texts.

    All jobs share this schema, whatever datasets they have, so `write_jobs` never has to change it.
    """
    rows = priced(fleet_profile(samples, groups, limit).drop(POSITION, "has_energy_data"), prices)
    return clean_cast(rows).withColumn("values", clean_values("values"))
