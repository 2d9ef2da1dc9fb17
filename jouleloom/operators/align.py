"""All datasets of a job on one timeline."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.keys import JOB, ROW, SEG, SEP, SUB, TIME, is_hidden, present, tie
from jouleloom.operators.frames import Frames
from jouleloom.operators.scan import Order, interpolate
from jouleloom.plans.segments import Prepared
from jouleloom.session import written

PREV_TIME = "prev~time"


@dataclass(frozen=True)
class Timeline:
    """Wide rows in job order: `{prefix}__{field}` columns plus hidden order and presence columns."""

    df: DataFrame
    order: Order
    sources: tuple[tuple[str, str, T.DataType], ...]  # (column, prefix, type)

    def with_df(self, df: DataFrame) -> Timeline:
        return replace(self, df=df)

    def visible(self) -> DataFrame:
        return self.df.select(
            *[F.col(f"`{c}`") for c in self.df.columns if not is_hidden(c) and c != PREV_TIME]
        )


def timeline_union(frames: Frames) -> DataFrame:
    """Every distinct time of a job, one row each; a missing time is one row, too."""
    return frames.df.select(*JOB, TIME).distinct()


def align(prepared: Prepared) -> Timeline:
    """Left-join every frame onto the timeline of its job.

    Equal to joining the frames one after another: where a frame has several rows at one time, the
    rows multiply. The stacked frames are shuffled once by job (and segment); the rows of one time
    meet in one group, whose size the plan bounds, and `explode_outer` per frame multiplies them.
    """
    frames = prepared.frames
    part = [*JOB, SEG] if prepared.split else list(JOB)
    rows = frames.df
    if prepared.hot is not None:
        usual = _align_groups(rows.join(prepared.hot, part, "left_anti"), frames, part)
        usual = usual.withColumn(SUB, F.array().cast("array<bigint>"))
        crowded = _align_chunks(rows.join(prepared.hot, part, "left_semi"), frames, part, prepared.chunk_rows)
        wide = usual.unionByName(crowded)
    else:
        wide = _align_groups(rows, frames, part)
    order = Order(tuple(JOB), (TIME, *map(tie, frames.prefixes)), prepared.segment)
    return Timeline(wide, order, tuple(frames.columns()))


def _align_groups(rows: DataFrame, frames: Frames, part: list[str]) -> DataFrame:
    # Rows lie by `part`, so the groups need no further exchange; a list is built once per time.
    found = []
    for p in frames.prefixes:
        data = F.col(f"`{p}`")
        timed = data.isNotNull() & F.col(TIME).isNotNull()
        found.append(F.collect_list(F.when(timed, F.struct(F.col(ROW).alias("at"), data.alias("data")))).alias(p))
        found.append((F.count(data) > 0).alias(present(p)))
    met = rows.repartition(*part).groupBy(*part, TIME).agg(*found)
    for p in frames.prefixes:
        met = met.withColumn(p, F.explode_outer(f"`{p}`"))
    return _widen(met, frames, part, lambda p: (F.col(f"`{p}`")["at"], F.col(f"`{p}`")["data"]))


def _align_chunks(rows: DataFrame, frames: Frames, part: list[str], chunk_rows: int) -> DataFrame:
    """The same result for crowded segments, joined by chunks of each frame's rows.

    The skeleton lists which chunks meet at a time, so a time with very many rows is spread over many
    join keys, each with about `chunk_rows` resulting rows. Rows of a time are ordered by the row number
    of the first dataset, then of the second, and so on. For chunks to keep that order, all datasets
    before the one that is cut into ranges are cut into single rows and all after it are left whole. That
    follows from the size of a dataset's chunk: `chunk_rows` by the product of the later datasets' rows.
    """
    at = [*part, TIME]
    counts = [F.count(F.when(F.col(f"`{p}`").isNotNull(), 1)).alias(f"n~{p}") for p in frames.prefixes]
    meets = rows.groupBy(*at).agg(*counts)
    later, sizes = F.lit(1.0), {}
    for p in reversed(frames.prefixes):
        sizes[f"size~{p}"] = F.greatest(F.lit(1), F.floor(F.lit(chunk_rows) / later)).cast("bigint")
        later = later * F.greatest(F.col(f"`n~{p}`"), F.lit(1))
    meets = meets.withColumns({**sizes, **{present(p): F.col(f"`n~{p}`") > 0 for p in frames.prefixes}})
    chunked: dict[str, DataFrame] = {}
    wide = meets.select(*at, *[f"`{present(p)}`" for p in frames.prefixes])
    for p in frames.prefixes:
        timed = rows.where(F.col(f"`{p}`").isNotNull() & F.col(TIME).isNotNull())
        sized = timed.join(meets.select(*at, f"`n~{p}`", f"`size~{p}`"), at)
        whole = F.col(f"`size~{p}`") >= F.col(f"`n~{p}`")
        number = F.when(whole, 0).otherwise(F.floor(F.col(ROW) / F.col(f"`size~{p}`"))).alias(f"chunk~{p}")
        chunked[p] = sized.select(*at, number, F.col(ROW).alias(tie(p)), F.col(f"`{p}`"))
        wide = wide.join(chunked[p].select(*at, f"`chunk~{p}`").distinct(), at, "left")
    for p in frames.prefixes:
        wide = wide.join(chunked[p], [*at, f"chunk~{p}"], "left")
    chunks = [F.coalesce(f"`chunk~{p}`", F.lit(-1)) for p in frames.prefixes]
    sub = F.array(F.coalesce(TIME, F.lit(-1)), *chunks).cast("array<bigint>")
    return _widen(
        wide.withColumn(SUB, sub), frames, [*part, SUB], lambda p: (F.col(f"`{tie(p)}`"), F.col(f"`{p}`"))
    )


def _widen(rows: DataFrame, frames: Frames, part: list[str], get) -> DataFrame:
    columns = [*part, TIME]
    for p in frames.prefixes:
        at, data = get(p)
        columns += [at.alias(tie(p)), F.col(f"`{present(p)}`")]
        columns += [data[f.name].alias(f"{p}{SEP}{f.name}") for f in frames.fields(p)]
    return rows.select(*columns)


def numeric_columns(timeline: Timeline) -> list[str]:
    """Columns to interpolate, by type: numbers only, no booleans, strings or arrays."""
    return [c for c, _, t in timeline.sources if isinstance(t, T.NumericType)]


def fill(timeline: Timeline) -> Timeline:
    """Interpolate all numeric columns; the same scan finds previous times and present datasets.

    A split scan uses its input twice, so what it gives for split jobs is written: the next scan would
    run it twice again.
    """
    flags = {present(p): present(p) for p in dict.fromkeys(p for _, p, _ in timeline.sources)}
    df = interpolate(
        timeline.df, numeric_columns(timeline), timeline.order, lags={PREV_TIME: TIME}, flags=flags
    )
    if timeline.order.segment:
        split = written(df.where(F.col(SEG).isNotNull()), "filled-segments")
        df = df.where(F.col(SEG).isNull()).unionByName(split)
    return timeline.with_df(df)
