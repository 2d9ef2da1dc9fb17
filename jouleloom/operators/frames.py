"""Frames: the datasets of a job as rows, before they are put on one timeline.

All frames are kept in one *stacked* DataFrame: job key, `ElapsedTime`, `row_idx` and one struct
column per dataset prefix, of which exactly one is non-null in each row. Whatever the number of
datasets, the source is read once and shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.functions.numbers import is_finite, truncate_to_long
from jouleloom.keys import JOB, ROW, SEP, TIME

MAX_TIME = 2.0**63


@dataclass(frozen=True)
class Frames:
    """Stacked frames and their prefixes in dataset order."""

    df: DataFrame
    prefixes: tuple[str, ...]

    def with_df(self, df: DataFrame) -> Frames:
        return replace(self, df=df)

    def fields(self, prefix: str) -> list[T.StructField]:
        return list(self.df.schema[prefix].dataType.fields)

    def columns(self) -> list[tuple[str, str, T.DataType]]:
        """(column on the timeline, prefix, type) in dataset order, then field order."""
        return [
            (f"{p}{SEP}{f.name}", p, f.dataType) for p in self.prefixes for f in self.fields(p)
        ]

    def field(self, prefix: str, name: str) -> Column | None:
        found = any(f.name == name for f in self.fields(prefix))
        return F.col(f"`{prefix}`")[name] if found else None


def stack(frames: Mapping[str, DataFrame]) -> Frames:
    """Stack one DataFrame per prefix (dict order = dataset order).

    Each has the job key, `row_idx`, metric columns and usually `ElapsedTime`; without it the row
    index counts as time.
    """
    stacked: DataFrame | None = None
    for prefix, frame in frames.items():
        metrics = [c for c in frame.columns if c not in (*JOB, ROW, TIME)]
        time = F.col(TIME) if TIME in frame.columns else F.col(ROW)
        rows = frame.select(
            *JOB,
            time.cast("double").alias(TIME) if not _integral(frame, TIME) else time.cast("bigint").alias(TIME),
            F.col(ROW).cast("bigint").alias(ROW),
            F.struct(*[F.col(f"`{m}`") for m in metrics]).alias(prefix),
        )
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no frames")
    return Frames(stacked, tuple(frames))


def _integral(frame: DataFrame, column: str) -> bool:
    return column not in frame.columns or isinstance(frame.schema[column].dataType, T.IntegralType)


def time_is_valid(t: Column) -> Column:
    """Whether a time can become a non-negative integer. A missing time is valid."""
    d = t.cast("double")
    return t.isNull() | (is_finite(d) & (d >= 0) & (d < MAX_TIME))


def truncate_time(frames: Frames) -> Frames:
    """Integer times, fraction dropped; invalid ones become null (see `quarantined_files`)."""
    valid = F.when(time_is_valid(F.col(TIME)), truncate_to_long(F.col(TIME)))
    return frames.with_df(frames.df.withColumn(TIME, valid))


def elapsed_validate(df: DataFrame, time: str = TIME) -> DataFrame:
    """Per file: rows with a valid time, rows without, and whether the file is set aside."""
    ok = time_is_valid(F.col(time))
    return (
        df.groupBy("file_label")
        .agg(F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("bad_rows"))
        .withColumn("quarantined", F.col("bad_rows") > 0)
    )


def job_facts(frames: Frames) -> DataFrame:
    """One row per job from one narrow pass: sizes, time span and what is wrong with its frames.

    Columns: n_rows, t_min, t_max, n (map prefix -> rows), zero_power (prefixes whose power sums
    to zero), usable (prefixes left), bad_time, bad_epoch.
    """
    t = F.col(TIME)
    bad_time = ~time_is_valid(t)
    long = F.when(~bad_time, truncate_to_long(t))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(long).alias("t_min"), F.max(long).alias("t_max")]
    for p in frames.prefixes:
        has = F.col(f"`{p}`").isNotNull()
        aggs.append(F.count_if(has).alias(f"n~{p}"))
        aggs.append(F.count_if(has & bad_time).alias(f"bad~{p}"))
        power = frames.field(p, "NodePower")
        if power is not None:
            total = F.sum(F.when(has, F.coalesce(power.cast("double"), F.lit(0.0))))
            aggs.append(total.alias(f"power~{p}"))
        epoch = frames.field(p, "EpochTime")
        if epoch is not None:
            aggs.append(F.count_if(epoch.isNotNull() & ~is_finite(epoch)).alias(f"epoch~{p}"))
    per_job = frames.df.groupBy(*JOB).agg(*aggs)

    def zero(p: str) -> Column:
        if f"power~{p}" not in per_job.columns:
            return F.lit(False)
        return (F.col(f"`n~{p}`") > 0) & F.coalesce(F.col(f"`power~{p}`") == 0, F.lit(False))

    def names(test) -> Column:
        picked = [F.when(test(p), F.lit(p)) for p in frames.prefixes]
        return F.array_compact(F.array(*picked))

    def usable(p: str) -> Column:
        return (F.col(f"`n~{p}`") > 0) & ~zero(p)

    epochs = epoch_candidates([(p, p) for p in frames.prefixes if f"epoch~{p}" in per_job.columns])
    chosen_bad = F.lit(False)
    for _, p in reversed(epochs):
        chosen_bad = F.when(usable(p), F.col(f"`epoch~{p}`") > 0).otherwise(chosen_bad)
    any_bad_time = F.lit(False)
    for p in frames.prefixes:
        any_bad_time = any_bad_time | (usable(p) & (F.col(f"`bad~{p}`") > 0))
    pairs = [x for p in frames.prefixes for x in (F.lit(p), F.col(f"`n~{p}`"))]
    return per_job.select(
        *JOB,
        "n_rows",
        "t_min",
        "t_max",
        F.create_map(*pairs).alias("n"),
        names(zero).alias("zero_power"),
        names(usable).alias("usable"),
        any_bad_time.alias("bad_time"),
        chosen_bad.alias("bad_epoch"),
    )


def epoch_candidates(columns: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """(column, prefix) pairs with the `Energy` dataset moved to the front."""
    return [c for c in columns if c[1] == "Energy"] + [c for c in columns if c[1] != "Energy"]


def quarantined_files(facts: DataFrame, first_only: bool = False) -> DataFrame:
    """(file_label, reason) of files set aside because of a value that cannot be converted.

    With `first_only` a file counts by its first usable group, as nothing of the later ones is used.
    """
    if first_only:
        facts = facts.join(first_usable_group(facts), JOB, "left_semi")
    return (
        facts.groupBy("file_label")
        .agg(F.max("bad_time").alias("bad_time"), F.max("bad_epoch").alias("bad_epoch"))
        .where("bad_time or bad_epoch")
        .select(
            "file_label",
            F.when(F.col("bad_time"), "invalid_elapsed").otherwise("invalid_epoch").alias("reason"),
        )
    )


def rejected_files(facts: DataFrame, first_only: bool = False) -> DataFrame:
    """(file_label, reason) of all files that give no table: those set aside, and those without anything usable."""
    unusable = facts.groupBy("file_label").agg(F.max(F.size("usable")).alias("most")).where("most = 0")
    return quarantined_files(facts, first_only).unionByName(unusable.select("file_label", F.lit("no_usable_data").alias("reason")))


def surviving_frames(facts: DataFrame) -> DataFrame:
    """(job, prefix, n) of the frames that are neither empty nor of zero power."""
    return facts.select(*JOB, F.explode("usable").alias("prefix"), "n").select(
        *JOB, "prefix", F.col("n")[F.col("prefix")].alias("n")
    )


def first_usable_group(facts: DataFrame) -> DataFrame:
    """Per file the first group, by name, that has any usable frame."""
    return (
        facts.where(F.size("usable") > 0)
        .groupBy("file_label")
        .agg(F.min("group_name").alias("group_name"))
    )


def frame_diagnostics(catalog: DataFrame, facts: DataFrame) -> DataFrame:
    """Per job: datasets that are empty, of zero power or failed to load, and the total.

    `catalog` has one row per dataset: job key, `prefix` and optionally `error` (boolean).
    """
    error = F.col("error") if "error" in catalog.columns else F.lit(False)
    known = catalog.select(*JOB, "prefix", F.coalesce(error, F.lit(False)).alias("error"))
    counted = known.join(facts.select(*JOB, "n", "zero_power"), JOB, "left")
    rows = F.coalesce(F.try_element_at("n", F.col("prefix")), F.lit(0))
    zero = F.coalesce(F.array_contains("zero_power", F.col("prefix")), F.lit(False))
    return counted.groupBy(*JOB).agg(
        F.count_if(~F.col("error") & (rows == 0)).alias("empty"),
        F.count_if(~F.col("error") & zero).alias("zero_power"),
        F.count_if("error").alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )


def unusable_files(diagnostics: DataFrame) -> DataFrame:
    """Totals of the files in which no group has a usable dataset."""
    counts = ["empty", "zero_power", "errors", "total"]
    left = F.col("total") - F.col("empty") - F.col("zero_power") - F.col("errors")
    return (
        diagnostics.groupBy("file_label")
        .agg(F.max(left).alias("usable"), *[F.sum(c).alias(c) for c in counts])
        .where("usable = 0")
        .drop("usable")
    )
