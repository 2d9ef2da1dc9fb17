"""Small builders shared by the tests."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from jouleloom.keys import JOB
from jouleloom.operators.frames import stack

LABEL, GROUP = "j1_run", "g"


def frame(spark, schema: str, rows, label=LABEL, group=GROUP):
    """Rows of one dataset, numbered in the given order, for one job."""
    data = [(label, group, i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"file_label string, group_name string, row_idx bigint, {schema}")


def frames(spark, **named):
    """name -> (schema, rows) as stacked frames."""
    return stack({p: frame(spark, schema, rows) for p, (schema, rows) in named.items()})


def table(df, *columns, order=()):
    picked = df.select(*[F.col(f"`{c}`") for c in columns])
    return [tuple(r) for r in (picked.orderBy(*order) if order else picked).collect()]


def key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    return str(value)


def rows_of(df, digits=6):
    """Order-free, type-free content of a DataFrame."""

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, digits) + 0.0
        return v

    names = sorted(df.columns)
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=lambda t: tuple(map(str, t)))


__all__ = ["GROUP", "JOB", "LABEL", "frame", "frames", "key", "rows_of", "table"]
