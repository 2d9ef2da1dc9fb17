"""Columns chosen or derived by name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.numbers import truncate_to_long
from jouleloom.keys import SEP, present
from jouleloom.operators.align import Timeline
from jouleloom.operators.frames import epoch_candidates

POWER_NAMES = ("NodePower", "CurrPower")
ENERGY_NAMES = ("Energy",)
CORES = 32


def named(column: str, names: Sequence[str]) -> bool:
    return any(column == n or column.endswith(f"__{n}") for n in names)


def candidates(timeline: Timeline, names: Sequence[str]) -> list[tuple[str, str]]:
    """(column, prefix) pairs whose name fits, in column order."""
    return [(c, p) for c, p, _ in timeline.sources if named(c, names)]


def resolve_first(found: Sequence[tuple[str, str]]) -> Column:
    """The first candidate whose dataset exists in the row's job, even if its value is null.

    A job without the dataset has the column too, because all jobs share one schema; so the choice
    looks at presence, not at values.
    """
    chosen = None
    for column, prefix in found:
        has, value = F.col(f"`{present(prefix)}`"), F.col(f"`{column}`").cast("double")
        chosen = F.when(has, value) if chosen is None else chosen.when(has, value)
    return F.lit(None).cast("double") if chosen is None else chosen


def any_present(found: Sequence[tuple[str, str]]) -> Column:
    result = F.lit(False)
    for prefix in dict.fromkeys(p for _, p in found):
        result = result | F.col(f"`{present(prefix)}`")
    return result


def resolve_epoch(timeline: Timeline) -> Timeline:
    """`EpochTime` from the energy dataset, else from the first dataset that has it."""
    found = [(c, p) for c, p, _ in timeline.sources if c.endswith("__EpochTime")]
    if not found or "EpochTime" in timeline.df.columns:
        return timeline
    ranked = epoch_candidates([f for f in found if f[0] == "Energy__EpochTime"]) + [
        f for f in found if f[0] != "Energy__EpochTime"
    ]
    return timeline.with_df(timeline.df.withColumn("EpochTime", truncate_to_long(resolve_first(ranked))))


@dataclass(frozen=True)
class Derived:
    """Columns that end with `__<source>` give one with `__<name>` in place of every `__<source>`, divided by `per`."""

    source: str
    name: str
    per: float


# Which figures are derived, under which name, and in which unit.
def derived_figures(cores: int) -> tuple[Derived, ...]:
    return (Derived("RSS", "RSS_MB", 1024.0), Derived("CPUUtilization", "CPUUtilization_normalized", float(cores)))


def add_task_derivatives(df: DataFrame, cores: int = CORES) -> DataFrame:
    """Memory in megabytes and utilisation per core, from the values before cleaning."""
    made = {
        c.replace(SEP + d.source, SEP + d.name): F.col(f"`{c}`").try_cast("double") / d.per
        for c in df.columns
        for d in derived_figures(cores)
        if c.endswith(SEP + d.source)
    }
    return df.withColumns(made)
