"""How the rows of every job are spread over tasks.

One narrow pass over the frames finds the jobs that need something special: files to skip, frames
to drop, and jobs too long for one task. Only those are listed, so the list stays small: there are
at most total_rows / segment_rows long jobs. It is written to the shared folder, and Catalyst
broadcasts it only if its real size allows. Where nothing is special, nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jouleloom.keys import JOB, ROW, SEG, SUB, TIME
from jouleloom.operators.frames import Frames, first_usable_group, job_facts, quarantined_files, truncate_time
from jouleloom.operators.scan import Order, row_positions
from jouleloom.session import written

SEGMENT_ROWS = 262_144  # input rows one task should scan
HOT_FACTOR = 4  # a segment above this many times SEGMENT_ROWS is split further
CHUNK_ROWS = 16_384  # rows of one dataset in one chunk of a split segment


@dataclass(frozen=True)
class Prepared:
    """Frames ready to align: valid, integer times, segment column where a job is split."""

    frames: Frames
    split: bool = False
    hot: DataFrame | None = None
    chunk_rows: int = CHUNK_ROWS
    facts: DataFrame | None = None

    @property
    def segment(self) -> tuple[str, ...]:
        if not self.split:
            return ()
        return (SEG,) if self.hot is None else (SEG, SUB)


def special_jobs(facts: DataFrame, groups: str, segment_rows: int) -> DataFrame:
    """The jobs that need special treatment, and which."""
    if groups not in ("first", "all"):
        raise ValueError("groups must be 'first' or 'all'")
    bad = quarantined_files(facts, groups == "first").select("file_label", F.lit(True).alias("bad"))
    rows = facts.join(bad, "file_label", "left")
    skip = F.coalesce(F.col("bad"), F.lit(False)) | (F.size("usable") == 0)
    if groups == "first":
        chosen = first_usable_group(facts).withColumnRenamed("group_name", "chosen")
        rows = rows.join(chosen, "file_label", "left")
        skip = skip | ~F.col("group_name").eqNullSafe(F.col("chosen"))
    rows = rows.withColumn("skip", skip)
    is_long = (F.col("n_rows") > segment_rows) & F.col("t_min").isNotNull()
    return rows.select(
        *JOB, "skip", F.col("zero_power").alias("drop"), F.when(is_long & ~F.col("skip"), F.col("n_rows")).alias("long")
    ).where("skip or size(drop) > 0 or long is not null")


def prepare(
    frames: Frames,
    groups: str = "all",
    segment_rows: int = SEGMENT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> Prepared:
    """Validate frames and decide how jobs are split."""
    facts = written(job_facts(frames), "job-facts")
    special = special_jobs(facts, groups, segment_rows)
    found = special.agg(
        F.count(F.lit(1)).alias("jobs"), F.sum("long").alias("long"), F.count_if(F.size("drop") > 0).alias("drops")
    ).first()
    frames = truncate_time(frames)
    if not found["jobs"]:
        return Prepared(frames, facts=facts)
    special = written(special, "special-jobs")

    rows = frames.df.join(special, JOB, "left").where(~F.coalesce(F.col("skip"), F.lit(False)))
    if found["drops"]:
        kept = {
            p: F.when(~F.coalesce(F.array_contains("drop", F.lit(p)), F.lit(False)), F.col(f"`{p}`"))
            for p in frames.prefixes
        }
        rows = _without_dropped(rows, frames, kept)
    if not found["long"]:
        return Prepared(frames.with_df(rows.drop("skip", "drop", "long")), facts=facts)
    # Sampled ranges of (job, time): segments of about equal size whatever the times look like, and all
    # rows of a time in one of them. Written, so that the ranges are fixed and the source is read once.
    spread = rows.where("long is not null").drop("skip", "drop", "long")
    spread = spread.repartitionByRange(-(-found["long"] // max(segment_rows, SEGMENT_ROWS)), *JOB, TIME)
    segments = written(spread.withColumn(SEG, F.spark_partition_id().cast("bigint")), "long-jobs")
    if segment_rows < SEGMENT_ROWS:
        segments = written(_cut(segments, segment_rows), "cut-segments")
    others = rows.where("long is null").drop("skip", "drop", "long").withColumn(SEG, F.lit(None).cast("bigint"))
    hot = written(
        segments.groupBy(*JOB, SEG)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > HOT_FACTOR * segment_rows)
        .select(*JOB, SEG),
        "hot-segments",
    )
    return Prepared(
        frames.with_df(others.unionByName(segments)), True, None if hot.isEmpty() else hot, chunk_rows, facts
    )


def _cut(ranges: DataFrame, segment_rows: int) -> DataFrame:
    """Segments below the size of a task: several in a range, so that ranges and tasks don't grow in number as they shrink.

    Rows of a time have one rank, so they stay together.
    """
    within = Window.partitionBy(*JOB, SEG).orderBy(F.col(TIME).asc_nulls_first())
    place = F.floor((F.rank().over(within) - 1) / segment_rows)
    return ranges.withColumn(SEG, F.shiftleft(SEG, 32) + place)


def _without_dropped(rows: DataFrame, frames: Frames, kept: dict[str, Column]) -> DataFrame:
    some = F.lit(False)
    for p in frames.prefixes:
        some = some | F.col(f"`{p}`").isNotNull()
    return rows.withColumns(kept).where(some)


def dataset_positions(prepared: Prepared) -> DataFrame:
    """Rows of every dataset as (job, prefix, ElapsedTime, row_idx, position), position from 0.

    The position is the row index by time, what a dataset without a row number of its own needs.
    """
    frames = prepared.frames
    names = [F.when(F.col(f"`{p}`").isNotNull(), F.lit(p)) for p in frames.prefixes]
    kept = [*JOB, TIME, ROW, *([SEG] if prepared.split else [])]
    rows = frames.df.select(*kept, F.coalesce(*names).alias("prefix"))
    if prepared.hot is not None:
        crowded = prepared.hot.withColumn("hot", F.lit(True))
        chunk = F.array(F.coalesce(TIME, F.lit(-1)), F.floor(F.col(ROW) / prepared.chunk_rows))
        plain = F.array().cast("array<bigint>")
        rows = rows.join(crowded, [*JOB, SEG], "left").withColumn(
            SUB, F.when(F.col("hot"), chunk.cast("array<bigint>")).otherwise(plain)
        )
    order = Order((*JOB, "prefix"), (TIME, ROW), prepared.segment)
    return row_positions(rows, order, "position").select(*JOB, "prefix", TIME, ROW, "position")


def laid_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = None) -> tuple[DataFrame, Order]:
    """`df` and the order to scan it in, by any sortable columns.

    If a key has more than `limit` rows, rows are laid out by sampled ranges and written, so that the ranges
    are fixed, and each range of a key is a segment.
    """
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= (limit or SEGMENT_ROWS):
        return df, Order(tuple(keys), tuple(order))
    ranges = df.repartitionByRange(*keys, *order).withColumn(SEG, F.spark_partition_id())
    return written(ranges, "ranges"), Order(tuple(keys), tuple(order), (SEG,))


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, limit: int = SEGMENT_ROWS
) -> DataFrame:
    """0-based position of every row within its key, laid out as above."""
    parts, by = laid_out(df, keys, order, limit)
    return row_positions(parts, by, out).drop(SEG)
