"""Results as CSV files with a header; a missing value is an empty field."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.text import sanitize_parts
from jouleloom.keys import JOB, TIME
from jouleloom.operators.prices import EPOCH


def with_export_name(df: DataFrame, ending: str = "") -> DataFrame:
    """Add the export name of the row's job, `<file>__<group>__combined<ending>`."""
    name = sanitize_parts(F.col("file_label"), F.col("group_name"), F.lit("combined"))
    return df.withColumn("export", F.concat(name, F.lit(ending)) if ending else name)


def write_csv(df: DataFrame, path: str, ending: str = "", order: Sequence[str] = (), without: Sequence[str] = ()) -> None:
    """One folder per job under `path`, named after its export name; rows in the given order.

    Sampled ranges of (job, order) are laid over the tasks, so that no task holds a whole long job and
    the files of a job follow each other in order. Columns in `without` only order the rows.
    """
    named = with_export_name(df, ending).drop(*JOB)
    by = ["export", *order]
    (
        named.repartitionByRange(*[F.col(f"`{c}`") for c in by])
        .sortWithinPartitions(*[F.col(f"`{c}`") for c in by])
        .drop(*without)
        .write.mode("overwrite")
        .option("header", "true")
        .option("emptyValue", "")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("export")
        .csv(path)
    )


def write_report(report, folder: str) -> None:
    """All parts of a report: combined rows, statistics, summaries, and prices if there are any."""
    write_csv(report.combined, os.path.join(folder, "combined"), order=[TIME])
    write_csv(report.stats, os.path.join(folder, "stats"), "_stats")
    write_csv(report.summary, os.path.join(folder, "summary"), "_summary", order=["ord"], without=["ord"])
    if report.prices is not None:
        write_csv(report.prices, os.path.join(folder, "prices"), "_prices", order=[EPOCH])
