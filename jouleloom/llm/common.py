"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jouleloom.session import written

#: Names of helper columns start with this, so that no input column clashes with them.
OWN = "__llm_"


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bound what one Arrow batch holds, by rows and by bytes; lower settings of the session stay."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def row_key(*columns: str, salt: int = 0) -> Column:
    """A long that depends on the values and on which of them are null."""
    parts: list[Column] = [F.lit(salt)]
    for c in columns:
        parts += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`")]
    return F.xxhash64(*parts)


#: Distinct rows that one part of a group holds on average, and equal rows that are numbered together.
PART_ROWS = 1 << 16
TOGETHER = 1 << 12


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str, spread: Column | None = None) -> DataFrame:
    """Number the rows of every group from 0 without gaps, in column `out`.

    Rows are in the order of `spread`, a number from 0 to 2^32 - 1 that follows from `order` (by default a
    hash of it), then of `order`. Rows that agree in all columns are counted first and numbered as one, and
    ranges of `spread` cut each group into parts, more of them the more rows there are: parts are counted,
    numbered inside, and moved by the counts of those before. So no task sees a whole group or all copies of a
    row, however hot they are. Rows that agree in `order` only may swap numbers; these should be few.
    """
    part, first, local, at, n = (OWN + x for x in ("part", "first", "local", "spread", "copies"))
    place = F.pmod(F.xxhash64(*order), F.lit(2**32)) if spread is None else spread
    distinct = written(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n)).withColumn(at, place.cast("bigint")), "numbered-rows")
    rows, hot = distinct.agg(F.count(F.lit(1)), F.sum(F.when(F.col(n) > TOGETHER, F.col(n)))).first()
    chunks = -(-rows // PART_ROWS) or 1
    parted = distinct.withColumn(part, F.shiftright(F.col(at) * F.lit(chunks), 32).cast("int"))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parted.groupBy(*groups, part)
        .agg(F.sum(n).alias(local))
        .select(*[F.col(g).alias(OWN + "of_" + g) for g in groups], F.col(part).alias(part + "_of"), F.coalesce(F.sum(local).over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(*groups, part).orderBy(at, *order, *[c for c in df.columns if c not in order]).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col(part) == F.col(part + "_of")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(OWN + "of_" + g))
    placed = parted.withColumn(local, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(starts, same).withColumn(first, F.col(first) + F.col(local))

    def copies(of: DataFrame, start: Column, stop: Column) -> DataFrame:
        return of.select(*df.columns, F.explode(F.sequence(start, stop - 1)).alias(out))

    stop = F.col(first) + F.col(n)
    if not hot:
        return copies(placed, F.col(first), stop)
    few = copies(placed.where(F.col(n) <= TOGETHER), F.col(first), stop)
    many = placed.where(F.col(n) > TOGETHER).withColumn(local, stop)
    many = many.withColumn(first, F.explode(F.sequence(F.col(first), stop - 1, F.lit(TOGETHER).cast("bigint"))))
    many = many.repartition(-(-hot // PART_ROWS), first)
    return few.union(copies(many, F.col(first), F.least(F.col(first) + TOGETHER, F.col(local))))
