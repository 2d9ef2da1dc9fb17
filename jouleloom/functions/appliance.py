"""Energy expressed as the running time of a household appliance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.numbers import float_text, scaled_half_even
from jouleloom.functions.text import unit_name

# Appliance and its power in watts. The order decides ties.
APPLIANCES: tuple[tuple[str, int], ...] = (
    ("a hair dryer", 1800),
    ("a microwave oven", 1200),
    ("an electric kettle", 1500),
    ("a vacuum cleaner", 800),
    ("a refrigerator", 150),
    ("a light bulb", 60),
    ("a washing machine", 500),
    ("a gaming PC", 400),
    ("a laptop", 60),
    ("a dishwasher", 1000),
)

# The sentences. %s stand for the appliance, the amount and the unit.
SENTENCE = "That's about the same energy as using %s for %s %s."
TOO_SMALL = "Energy use too small to compare with everyday appliances."
NOTHING = "negligible usage"

APPLIANCE_COLUMNS = ["appliance_name", "appliance_amount", "appliance_unit", "appliance_description"]


def with_appliance(
    df: DataFrame,
    joules: str,
    catalog: Sequence[tuple[str, int]] = APPLIANCES,
    target_min: float = 10.0,
) -> DataFrame:
    """Add name, amount, unit and sentence of the appliance whose running time is nearest the target.

    Running times of 1 to 120 minutes are preferred; only if no appliance has one, all compete.
    Steps are small projections over non-null numbers, so that each compiles to a method the JVM
    accepts for just-in-time compilation; one large expression would run interpreted.
    """
    given = F.col(f"`{joules}`").cast("double")
    some = F.coalesce((given > 0) & ~F.isnan(given), F.lit(False))
    places = range(len(catalog))
    steps = df.withColumns({"some~": some, "j~": F.coalesce(F.when(some, given), F.lit(1.0))})
    steps = steps.withColumns({f"min~{i}": F.col("`j~`") / float(w) / 60.0 for i, (_, w) in enumerate(catalog)})
    minutes = [F.col(f"`min~{i}`") for i in places]
    steps = steps.withColumns({f"far~{i}": F.abs(minutes[i] - target_min) for i in places})
    far = [F.col(f"`far~{i}`") for i in places]
    preferred = [minutes[i].between(1.0, 120.0) for i in places]
    steps = steps.withColumn("near~", F.least(*[F.when(preferred[i], far[i]) for i in places]))
    steps = steps.withColumns({"all~": F.isnull("`near~`"), "best~": F.coalesce("`near~`", F.least(*far))})
    # The first appliance at the least distance wins.
    chosen = F
    for i in places:
        chosen = chosen.when((far[i] == F.col("`best~`")) & (F.col("`all~`") | preferred[i]), i)
    steps = steps.withColumn("pick~", chosen)
    watts = F.array(*[F.lit(float(w)) for _, w in catalog])
    steps = steps.withColumn("secs~", F.coalesce(F.col("`j~`") / F.get(watts, "`pick~`"), F.lit(0.0)))
    s = F.col("`secs~`")
    steps = steps.withColumns(
        {
            "raw~": F.when(s < 60, s).when(s < 3600, s / 60.0).otherwise(s / 3600.0),
            "scale~": F.when(s < 3600, 10.0).otherwise(100.0),
        }
    )
    steps = steps.withColumn("amount~", scaled_half_even(F.col("`raw~`"), F.col("`scale~`")))
    amount = F.col("`amount~`")
    name = F.get(F.array(*[F.lit(n) for n, _ in catalog]), "`pick~`")
    steps = steps.withColumns(
        {
            "appliance_name": F.when(F.col("`some~`"), name).otherwise(NOTHING),
            "appliance_amount": F.when(F.col("`some~`"), amount).otherwise(0.0),
            "appliance_unit": F.when(F.col("`some~`") & (s >= 3600), "h")
            .when(F.col("`some~`") & (s >= 60), "m")
            .otherwise("s"),
        }
    )
    values = F.col("appliance_name"), float_text(F.col("appliance_amount")), unit_name(F.col("appliance_unit"))
    # The template is cut here, once; formatting it would be done anew for every row.
    before, *after = SENTENCE.split("%s")
    sentence = F.concat(F.lit(before), *[x for v, text in zip(values, after, strict=True) for x in (v, F.lit(text))])
    described = F.when(F.col("`some~`"), sentence).otherwise(TOO_SMALL)
    helpers = [c for c in steps.columns if c not in df.columns and c not in APPLIANCE_COLUMNS]
    return steps.withColumn("appliance_description", described).drop(*helpers)
