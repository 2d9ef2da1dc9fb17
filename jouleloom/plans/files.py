"""From a folder of containers to job tables, in one plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jouleloom.operators.frames import Frames
from jouleloom.plans.jobs import Build, build_jobs
from jouleloom.session import written
from jouleloom.sinks.tables import write_jobs
from jouleloom.sources.containers import container_files
from jouleloom.sources.files import latest_per_label


@dataclass(frozen=True)
class FileTables:
    """The tables of the files that can be used, and every other file with the reason."""

    build: Build
    quarantine: DataFrame


def tables_of_files(
    spark: SparkSession,
    root: str,
    load: Callable[[DataFrame], Frames],
    prices: DataFrame | None = None,
    groups: str = "first",
    keep_batch_files: bool = False,
) -> FileTables:
    """Discovery, checks, loading and building as one plan; each file is either in the tables or in the quarantine.

    `load` turns (file_label, path) into frames. Reasons: empty, unreadable or not_hdf5 containers, superseded by a later
    file of the same label, no_data if nothing was landed for the file, no_usable_data if nothing of it can be
    used, invalid_elapsed and invalid_epoch.
    """
    found = written(container_files(spark, root, keep_batch_files), "listed-files")
    usable = found.where("reason IS NULL").select("file_label", "path", F.lit(0).alias("src_ord"))
    last = written(latest_per_label(usable).select("file_label", "path"), "last-files")
    build = build_jobs(load(last), prices, groups)

    def because(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select("file_label", "path", F.lit(reason).alias("reason"))

    landed = build.facts.select("file_label").distinct()
    out = [
        found.where("reason IS NOT NULL").select("file_label", "path", "reason"),
        because(usable.join(last, ["file_label", "path"], "left_anti"), "superseded"),
        because(last.join(landed, "file_label", "left_anti"), "no_data"),
        build.quarantine.join(last, "file_label").select("file_label", "path", "reason"),
    ]
    return FileTables(build, reduce(DataFrame.union, out))


def write_tables(tables: FileTables, path: str) -> dict[str, int]:
    """Write jobs and quarantine below `path`; rows, columns and files set aside, counted by the jobs that write them."""
    set_aside = Observation("quarantine")
    counts = write_build(tables.build, f"{path}/jobs")
    tables.quarantine.observe(set_aside, F.count(F.lit(1)).alias("files")).write.mode("overwrite").parquet(f"{path}/quarantine")
    return counts | {"quarantined": set_aside.get["files"]}


def write_build(build: Build, path: str) -> dict[str, int]:
    """Replace the jobs' tables, which share files; their rows and columns, observed while they are written."""
    seen = Observation("jobs")
    columns = len(build.table.columns)
    write_jobs(build.table.observe(seen, F.count(F.lit(1)).alias("rows"), F.lit(columns).alias("columns")), path, together=True)
    return {"rows": seen.get["rows"], "columns": columns}
