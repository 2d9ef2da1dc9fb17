"""Sums that are the same in every bit, however jobs are split and tasks are merged."""

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jouleloom.keys import JOB, TIME
from jouleloom.operators.align import align, fill
from jouleloom.operators.columns import add_task_derivatives, resolve_epoch
from jouleloom.operators.energy import energy_profile, job_metrics
from jouleloom.operators.exact import exact_sum
from jouleloom.operators.prices import EPOCH, add_cost, job_cost, nearest_prices
from jouleloom.operators.scan import Order, scan
from jouleloom.plans.segments import prepare
from workload.adapters import event_frames, event_prices


def bits(x):
    return None if x is None else struct.pack("<d", x)


def nearest(values):
    """The sum, of values rounded to multiples of 2^-64, as a double."""
    return sum(Fraction(round(Fraction(v) * 2**64), 2**64) for v in values)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.floats(-(2.0**40), 2.0**40) | st.floats(-1e-6, 1e-6) | st.integers(-(2**61), 2**61).map(float), min_size=1, max_size=60), seed=st.integers(0, 9))
def test_sums_do_not_depend_on_order(spark, values, seed):
    shuffled = random.Random(seed).sample(values, len(values))
    found = {bits(spark.createDataFrame([(v,) for v in of], "v double").repartition(n).agg(exact_sum(F.col("v"))).first()[0]) for of, n in ((values, 1), (shuffled, 3))}
    assert len(found) == 1
    got, want = struct.unpack("<d", found.pop())[0], nearest(values)
    assert abs(Fraction(got) - want) <= Fraction(math.ulp(float(want))) + Fraction(1, 2**53)


def test_sums_of_odd_values(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]

    inf, nan = float("inf"), float("nan")
    assert total(None, None) is None and total(1.5, None) == 1.5 and total(0.1, 0.2, -0.3) == float(Fraction(0.1) + Fraction(0.2) - Fraction(0.3))
    assert total(inf, 1.0) == inf and math.isnan(total(inf, -inf)) and math.isnan(total(nan, 1.0)) and total(1e300, 1.0) == 1e300
    assert total(*[0.1] * 1000) == float(1000 * Fraction(0.1)) and total(-5e-324, 1e-300) == 0.0


@pytest.mark.parametrize("sizes", [(3, 4), (50, 1)])
def test_running_sums_of_segments_equal_whole_ones(spark, sizes):
    rng = random.Random(3)
    rows = [(k, i, i // sizes[0], None if rng.random() < 0.2 else rng.choice([rng.uniform(-1, 1) * 10 ** rng.randint(-9, 12), 0.1])) for k in range(sizes[1]) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, i int, seg int, v double")
    whole, split = (scan(df, Order(("k",), ("i",), segment), sums={"s": "v"}) for segment in ((), ("seg",)))
    got = [{(r["k"], r["i"]): bits(r["s"]) for r in of.collect()} for of in (whole, split)]
    assert got[0] == got[1] and whole.columns == [*df.columns, "s"]
    for k in range(sizes[1]):
        seen = [r[3] for r in rows if r[0] == k]
        for i, v in enumerate(seen):
            s = got[0][k, i]
            assert (s is None) == (v is None)
            if v is not None:
                want = nearest(x for x in seen[: i + 1] if x is not None)
                assert abs(Fraction(struct.unpack("<d", s)[0]) - want) <= Fraction(math.ulp(float(want))) * 2


def test_split_and_whole_jobs_agree_in_every_bit(spark, sf):
    """Energy, its maximum and the costs: no rounding before the comparison."""
    tables, totals = [], []
    for split in ({}, {"segment_rows": 16, "chunk_rows": 8}):
        timeline = resolve_epoch(fill(align(prepare(event_frames(spark, sf), **split))))
        profile = energy_profile(timeline.with_df(add_task_derivatives(timeline.df))).df
        kept = profile.select(*JOB, TIME, EPOCH, "NodePower", "Energy_Increment_J", "Energy_used_J")
        tables.append(sorted((tuple(bits(v) if isinstance(v, float) else v for v in r) for r in kept.collect()), key=str))
        metrics = job_metrics(profile).select(*JOB, "energy_to_solution_j", "average_power_w")
        costs = job_cost(add_cost(nearest_prices(kept, event_prices(spark, sf), EPOCH)).repartition(7 if split else 2))
        totals.append([sorted((tuple(bits(v) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str) for df in (metrics, costs)])
    assert tables[0] == tables[1] and totals[0] == totals[1] and len(tables[0]) > 500
