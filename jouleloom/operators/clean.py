"""Range checks and narrower types, by column name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.functions.numbers import is_finite

BIG = 2**63 - 1


@dataclass(frozen=True)
class Rule:
    """Columns named `exact` or ending with `__<suffix>`; values to keep; resulting type."""

    exact: tuple[str, ...]
    suffix: tuple[str, ...]
    low: float
    high: float | None
    dtype: str

    def fits(self, column: str) -> bool:
        return column in self.exact or any(column.endswith(f"__{s}") for s in self.suffix)

    def apply(self, column: str, is_text: bool = False) -> Column:
        value = F.col(f"`{column}`")
        if is_text:
            value = value.try_cast("double")  # text that is no number is out of range
        keep = is_finite(value) & (value >= F.lit(self.low))
        if self.high is not None:
            keep = keep & (value <= F.lit(self.high))
        return F.when(keep, value).try_cast(self.dtype).alias(column)


# Names, inclusive ranges and types. The first rule that fits a column counts.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule(("ElapsedTime",), (), 0, BIG, "bigint"),
    Rule(("ElapsedTime_Diff",), (), 0, 365 * 24 * 3600 * 1000, "bigint"),
    Rule(("EpochTime",), ("EpochTime",), 0, 4_102_444_800, "bigint"),
    Rule((), ("CPUFrequency",), 0, 10_000, "int"),
    Rule((), ("RSS", "VMSize"), 0, BIG, "bigint"),
    Rule((), ("GPUMemMB", "RSS_MB"), 0, 1e6, "float"),
    Rule((), ("Pages",), 0, 2**32 - 1, "bigint"),
    Rule(("NodePower",), ("NodePower",), 0, 10_000, "float"),
    Rule(("CurrPower",), ("CurrPower",), 0, 10_000, "float"),
    Rule(("Energy_Increment_J", "Energy_used_J"), (), 0, None, "float"),
    Rule(("Energy",), ("Energy",), 0, None, "float"),
    Rule((), ("CPUUtilization", "GPUUtilization"), 0, 100, "float"),
    Rule((), ("CPUUtilization_normalized",), 0, 1, "float"),
    Rule((), ("CPUTime",), 0, None, "float"),
    Rule((), ("ReadMB", "WriteMB"), 0, None, "float"),
)


def clean_cast(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Null out values out of range and narrow the types; columns without a rule stay."""

    def cleaned(column: str) -> Column:
        rule = next((r for r in rules if r.fits(column)), None)
        is_text = isinstance(df.schema[column].dataType, T.StringType)
        return rule.apply(column, is_text) if rule else F.col(f"`{column}`")

    return df.select(*[cleaned(c) for c in df.columns])
