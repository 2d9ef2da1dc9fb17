"""From frames to per-job results, for all jobs in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jouleloom.keys import JOB
from jouleloom.operators.align import Timeline, align, fill
from jouleloom.operators.clean import clean_cast
from jouleloom.operators.columns import add_task_derivatives, resolve_epoch
from jouleloom.operators.describe import describe_columns
from jouleloom.operators.energy import energy_profile, has_energy_data, job_metrics, job_summary
from jouleloom.operators.frames import Frames, rejected_files
from jouleloom.operators.prices import EPOCH, PRICE, add_cost, epoch_bounds, job_cost, nearest_prices, price_block_cover, price_points
from jouleloom.plans.segments import SEGMENT_ROWS, Prepared, prepare
from jouleloom.session import written


@dataclass(frozen=True)
class Report:
    """Everything the report of all jobs consists of."""

    combined: DataFrame
    stats: DataFrame
    summary: DataFrame
    prices: DataFrame | None
    cost: DataFrame | None
    counts: DataFrame
    #: Files that have no part in it, with the reason; rows and columns of the combined table, observed while it was written.
    quarantine: DataFrame
    observed: dict[str, int]


@dataclass(frozen=True)
class Build:
    """The tables of all jobs, the files that give none with the reason, and the facts both follow from."""

    table: DataFrame
    quarantine: DataFrame
    facts: DataFrame


def job_profile(frames: Frames, groups: str = "all", segment_rows: int = SEGMENT_ROWS) -> Timeline:
    """Valid frames on one timeline per job, with derived and energy columns."""
    return profile_of(prepare(frames, groups, segment_rows))


def profile_of(prepared: Prepared) -> Timeline:
    timeline = resolve_epoch(fill(align(prepared)))
    return energy_profile(timeline.with_df(add_task_derivatives(timeline.df)))


def priced(df: DataFrame, prices: DataFrame | None) -> DataFrame:
    """Add price and cost, where there is a price series and an epoch column."""
    if prices is None or EPOCH not in df.columns or prices.isEmpty():
        return df
    return add_cost(nearest_prices(df, prices, EPOCH).drop("PriceEpochTime"))


def job_table(
    frames: Frames,
    prices: DataFrame | None = None,
    groups: str = "first",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """The cleaned table of every job; by default of a file's first usable group."""
    return build_jobs(frames, prices, groups, segment_rows).table


def build_jobs(
    frames: Frames,
    prices: DataFrame | None = None,
    groups: str = "first",
    segment_rows: int = SEGMENT_ROWS,
) -> Build:
    """`job_table`, and the files that it leaves out."""
    prepared = prepare(frames, groups, segment_rows)
    table = clean_cast(priced(profile_of(prepared).visible(), prices))
    return Build(table, rejected_files(prepared.facts, groups == "first"), prepared.facts)


def job_report(
    frames: Frames,
    prices: DataFrame | None = None,
    groups: str = "all",
    segment_rows: int = SEGMENT_ROWS,
) -> Report:
    """Uncleaned rows, column statistics and summary of every job, and prices if given.

    All parts start from the same wide rows, priced if there are prices, which are computed and written
    once. `prices` are those that cover the time of each job, `counts` the size of its combined table.
    """
    prepared, seen = prepare(frames, groups, segment_rows), Observation("combined")
    profile = profile_of(prepared)
    rows = priced(profile.df, prices).observe(seen, F.count(F.lit(1)).alias("rows"))
    profile = profile.with_df(written(rows, "profile"))
    combined = profile.visible()
    metrics = job_metrics(profile.df.where(has_energy_data(profile)))
    has_cost = "Cumulative_cost_EUR" in combined.columns
    stats = written(describe_columns(combined, JOB), "profile-stats")
    return Report(
        combined=combined,
        stats=stats,
        summary=job_summary(metrics),
        prices=covering_prices(combined, prices) if has_cost else None,
        cost=job_cost(combined) if has_cost else None,
        counts=table_counts(stats),
        quarantine=rejected_files(prepared.facts, groups == "first"),
        observed={"rows": seen.get["rows"], "columns": len(combined.columns)},
    )


def covering_prices(combined: DataFrame, prices: DataFrame) -> DataFrame:
    """The prices of each job: those inside its time span and the nearest one on either side."""
    points = price_points(prices)
    needed = price_block_cover(epoch_bounds(combined), points.select(F.col(EPOCH).alias("block")), JOB)
    return needed.withColumnRenamed("block", EPOCH).join(points, EPOCH).select(*JOB, EPOCH, PRICE)


def table_counts(stats: DataFrame) -> DataFrame:
    """Rows of every job, and the columns in which it has a value, from its statistics."""
    return stats.groupBy(*JOB).agg(
        F.max(F.col("count") + F.col("null_count")).alias("n_rows"), F.count_if(F.col("count") > 0).alias("n_columns")
    )
