"""The driver's tables as inputs of the library: events as job frames, orders as prices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.keys import JOB, ROW, TIME
from jouleloom.operators.align import Timeline, align, fill
from jouleloom.operators.columns import add_task_derivatives, resolve_epoch
from jouleloom.operators.energy import energy_profile
from jouleloom.operators.frames import Frames
from jouleloom.operators.prices import EPOCH, PRICE
from jouleloom.plans.segments import prepare
from jouleloom.session import written

# Event type -> dataset prefix, in dataset order.
DATASETS = {"purchase": "Energy", "click": "Task_0", "view": "Task_1", "signup": "Task_2", "error": "Task_3"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(ts: str) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / 1_000_000)


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a job key: one file per user, one group per half of the month."""
    half = F.when(F.dayofmonth("ts") <= 15, "g0").otherwise("g1")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id"), F.lit("_run")).alias("file_label"),
        half.alias("group_name"),
        epoch("ts").alias("ep"),
        "event_id",
        "user_id",
        "event_type",
        "value",
    )


def timed_events(spark: SparkSession, sf_dir: str, files: DataFrame | None = None) -> DataFrame:
    """Job events with the seconds since the job's first event; of the listed files, if any are listed."""
    events = job_events(spark, sf_dir)
    if files is not None:
        events = events.join(files, "file_label", "left_semi")
    starts = written(events.groupBy(*JOB).agg(F.min("ep").alias("start")), "job-starts")
    return events.join(starts, JOB).withColumn(TIME, F.col("ep") - F.col("start")).drop("start")


def event_frames(
    spark: SparkSession,
    sf_dir: str,
    energy: Callable[[], Column] | None = None,
    keep: Column | None = None,
    files: DataFrame | None = None,
) -> Frames:
    """All five datasets from one scan of the events.

    `energy` replaces the fields of the energy dataset; `keep` filters events first, `files` names some.
    """
    events = timed_events(spark, sf_dir, files)
    if keep is not None:
        events = events.where(keep)
    v, ep = F.col("value"), F.col("ep")
    usual = F.struct(v.alias("NodePower"), ep.alias("EpochTime"))
    fields = {
        "Energy": energy() if energy else usual,
        "Task_0": F.struct(v.alias("CPUUtilization")),
        "Task_1": F.struct((v * 1024).alias("RSS")),
        "Task_2": F.struct(v.alias("ReadMB")),
        "Task_3": F.struct(v.alias("CurrPower"), ep.alias("EpochTime")),
    }
    datasets = [
        F.when(F.col("event_type") == et, fields[prefix]).alias(prefix) for et, prefix in DATASETS.items()
    ]
    # The event id orders rows within a dataset just as a row index does.
    rows = events.select(*JOB, TIME, F.col("event_id").alias(ROW), *datasets)
    return Frames(rows, tuple(DATASETS.values()))


def event_timeline(spark: SparkSession, sf_dir: str, **kw) -> Timeline:
    """Aligned and interpolated events of all jobs."""
    return fill(align(prepare(event_frames(spark, sf_dir, **kw))))


def event_profile(spark: SparkSession, sf_dir: str, **kw) -> Timeline:
    """The same with epoch, task and energy columns."""
    timeline = resolve_epoch(event_timeline(spark, sf_dir, **kw))
    return energy_profile(timeline.with_df(add_task_derivatives(timeline.df)))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter-hour price series: the mean event value of each quarter hour."""
    e = epoch("ts")
    quarter = (F.floor(e / 900) * 900).alias(EPOCH)
    return table(spark, sf_dir, "events").groupBy(quarter).agg(quantized(F.avg("value"), 4).alias(PRICE))


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily price series: the mean order total of each day."""
    return table(spark, sf_dir, "orders").groupBy(epoch("o_orderdate").alias(EPOCH)).agg(
        quantized(F.avg("o_totalprice"), 4).alias(PRICE)
    )


def quantized(x: Column, digits: int) -> Column:
    """`digits` decimals, cut at a place where short decimal fractions never lie.

    Two engines that add in another order differ in the last bit; at a rounding tie that would
    show. The last addition turns a negative zero into zero.
    """
    scale = float(10**digits)
    return F.rint(x.cast("double") * scale - 0.12893761) / scale + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating point columns as quantized doubles, for comparison; epoch seconds have 3 decimals."""
    return df.select(
        *[
            quantized(F.col(f"`{f.name}`"), 3 if f.name.endswith("EpochTime") else digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rounded_statistics(df: DataFrame, digits: int) -> DataFrame:
    """The same for described columns; those of large figures keep no decimals."""
    large = F.col("metric").rlike("EpochTime$|RSS$|_J$")
    return df.select(
        *[
            F.when(large, quantized(F.col(f.name), 0)).otherwise(quantized(F.col(f.name), digits)).alias(f.name)
            if f.dataType.typeName() == "double"
            else f.name
            for f in df.schema.fields
        ]
    )
