"""Power, energy, job metrics and the job summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.appliance import APPLIANCE_COLUMNS, with_appliance
from jouleloom.functions.numbers import fixed2, nan
from jouleloom.functions.text import unit_name
from jouleloom.keys import JOB, TIME
from jouleloom.operators.align import PREV_TIME, Timeline
from jouleloom.operators.columns import (
    ENERGY_NAMES,
    POWER_NAMES,
    any_present,
    candidates,
    resolve_first,
)
from jouleloom.operators.scan import scan


def energy_profile(timeline: Timeline) -> Timeline:
    """Add `NodePower`, `ElapsedTime_Diff`, `Energy_Increment_J`, `Energy_used_J`.

    Each job takes one branch. With a power column, energy is the sum of power times the step to
    the previous row. Otherwise, with a metered energy column, power is its increment per second.
    A job with neither keeps its rows and gets nulls. Expects the scan of `fill`.
    """
    power, energy = candidates(timeline, POWER_NAMES), candidates(timeline, ENERGY_NAMES)
    has_power = any_present(power)
    has_energy = any_present(energy) & ~has_power
    step = (F.col(TIME) - F.col(f"`{PREV_TIME}`")).cast("double")
    df = timeline.df.withColumns(
        {
            "power~": resolve_first(power),
            "meter~": F.when(has_energy, resolve_first(energy)),
            "step~": step,
        }
    )
    df = df.withColumn("ElapsedTime_Diff", F.when(has_power, F.coalesce("`step~`", F.lit(0.0))))
    df = df.withColumn("added~", F.col("ElapsedTime_Diff") * F.col("`power~`"))
    lags = {"metered~": "meter~"} if energy else {}
    df = scan(df, timeline.order, lags=lags, sums={"total~": "added~"})
    if energy:
        grown = F.coalesce(F.col("`meter~`") - F.col("`metered~`"), F.lit(0.0))
    else:
        grown = F.lit(None).cast("double")
    rate = F.when(F.col("`step~`") > 0, grown / F.nullif("`step~`", F.lit(0.0)))
    df = df.withColumns(
        {
            "NodePower": F.when(has_power, F.col("`power~`")).when(has_energy, rate),
            "Energy_Increment_J": F.when(has_power, F.col("`added~`")).when(has_energy, grown),
            "Energy_used_J": F.when(has_power, F.col("`total~`")).when(has_energy, F.col("`meter~`")),
        }
    )
    return timeline.with_df(df.drop("power~", "meter~", "step~", "added~", "metered~", "total~"))


def has_energy_data(timeline: Timeline) -> Column:
    """Whether the row's job has any power or energy column."""
    return any_present(candidates(timeline, POWER_NAMES) + candidates(timeline, ENERGY_NAMES))


def job_metrics(profile: DataFrame) -> DataFrame:
    """Ten figures per job. Among equal power peaks the earliest time counts.

    `profile` holds only jobs with a power or energy column. Partial aggregates are combined
    before the shuffle, so a long job costs no more than a short one there.
    """
    used, t, power = F.col("Energy_used_J"), F.col(TIME).cast("double"), F.col("NodePower")
    peak = F.max(F.when(power.isNotNull(), F.struct(power.alias("w"), (-t).alias("t"))))
    ets, tts = F.col("energy_to_solution_j"), F.col("time_to_solution_s")
    moved = tts.isNotNull() & (tts != 0)
    best = F.col("`peak~`")
    figures = (
        profile.groupBy(*JOB)
        .agg(
            # NaN counts only if there is nothing else.
            F.coalesce(F.max(F.when(~F.isnan(used), used)), F.max(used)).alias("energy_to_solution_j"),
            F.max(t).alias("time_to_solution_s"),
            peak.alias("peak~"),
        )
        .select(
            *JOB,
            ets,
            tts,
            F.when(moved, ets / F.nullif(tts, F.lit(0.0))).otherwise(nan()).alias("average_power_w"),
            F.coalesce(best["w"], nan()).alias("peak_power_w"),
            F.when(best.isNull(), nan()).otherwise(-best["t"]).alias("peak_power_time_s"),
            F.when(moved & ~F.coalesce(F.isnan(ets), F.lit(False)), ets * tts)
            .otherwise(nan())
            .alias("energy_delay_product"),
        )
    )
    return with_appliance(figures, "energy_to_solution_j").select(*figures.columns, *APPLIANCE_COLUMNS)


# The rows of the summary in order, as metric, unit and description. %s stands for the time
# of the peak, or the appliance; the unit of the last row is that of its amount.
SUMMARY_ROWS = (
    ("Energy-to-solution", "J", "Total energy consumed by the job from start to finish."),
    ("Time-to-solution", "s", "Elapsed time for the job."),
    ("Average power", "W", "Mean power draw."),
    ("Peak power", "W", "Peak power observed at t=%ss."),
    ("Energy delay product", "J*s", "Energy-delay product."),
    ("Appliance comparison", None, "Equivalent to running %s."),
)


def job_summary(metrics: DataFrame) -> DataFrame:
    """Six rows per job: Metric, Value, Unit, Description, all text."""
    values = {
        "Energy-to-solution": "energy_to_solution_j",
        "Time-to-solution": "time_to_solution_s",
        "Average power": "average_power_w",
        "Peak power": "peak_power_w",
        "Energy delay product": "energy_delay_product",
        "Appliance comparison": "appliance_amount",
    }
    filled = {"Peak power": fixed2(F.col("peak_power_time_s")), "Appliance comparison": F.col("appliance_name")}

    def row(metric: str, unit: str | None, text: str) -> Column:
        return F.struct(
            F.lit(metric).alias("Metric"),
            fixed2(F.col(values[metric])).alias("Value"),
            (F.lit(unit) if unit else unit_name(F.col("appliance_unit"))).alias("Unit"),
            (_with(text, filled[metric]) if metric in filled else F.lit(text)).alias("Description"),
        )

    rows = F.array(*[row(*fixed) for fixed in SUMMARY_ROWS])
    numbered = metrics.select(*JOB, F.posexplode(rows).alias("at", "row"))
    return numbered.select(*JOB, (F.col("at") + 1).alias("ord"), "row.*")


def _with(text: str, value: Column) -> Column:
    """`text` around a value; null if the value is null."""
    before, after = text.split("%s")
    return F.concat(F.lit(before), value, F.lit(after))
