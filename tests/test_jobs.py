"""Hand-computed jobs: alignment, interpolation, energy, metrics, cleaning, groups."""

import math

import pytest
from pyspark.sql import functions as F

from jouleloom.functions import fixed2
from jouleloom.keys import JOB, TIME
from jouleloom.operators.align import align, fill
from jouleloom.operators.clean import clean_cast
from jouleloom.operators.columns import add_task_derivatives
from jouleloom.operators.energy import has_energy_data, job_metrics, job_summary
from jouleloom.operators.frames import job_facts, quarantined_files, stack, surviving_frames
from jouleloom.plans.jobs import job_profile, job_table
from jouleloom.plans.segments import prepare
from tests.helpers import frame, frames, rows_of, table

NAN = float("nan")


def example(spark):
    return frames(
        spark,
        Energy=(
            "ElapsedTime double, NodePower double, EpochTime bigint",
            [(0.0, 100.0, 1700000000), (4.0, 200.0, 1700000004)],
        ),
        Task_0=(
            "ElapsedTime double, CPUUtilization double, RSS double",
            [(1.0, 16.0, 2048.0), (2.0, None, None), (4.0, 64.0, 4096.0)],
        ),
    )


def test_power_branch(spark):
    profile = job_profile(example(spark))
    columns = [
        TIME, "Energy__NodePower", "Task_0__CPUUtilization", "Task_0__RSS", "EpochTime", "Task_0__RSS_MB",
        "Task_0__CPUUtilization_normalized", "ElapsedTime_Diff", "Energy_Increment_J", "Energy_used_J",
    ]
    rows = [tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in table(profile.df, *columns, order=[TIME])]
    # Interpolation counts rows: by time, power would be 125 and 150.
    assert rows == [
        (0, 100.0, None, None, 1700000000, None, None, 0.0, 0.0, 0.0),
        (1, 133.3333, 16.0, 2048.0, 1700000001, 2.0, 0.5, 1.0, 133.3333, 133.3333),
        (2, 166.6667, 40.0, 3072.0, 1700000002, 3.0, 1.25, 1.0, 166.6667, 300.0),
        (4, 200.0, 64.0, 4096.0, 1700000004, 4.0, 2.0, 2.0, 400.0, 700.0),
    ]
    metrics = job_metrics(profile.df)
    row = metrics.first()
    assert [round(row[i], 6) for i in range(2, 8)] == [700.0, 4.0, 175.0, 200.0, 4.0, 2800.0]
    assert tuple(row)[8:11] == ("a light bulb", 11.7, "s")
    summary = table(job_summary(metrics), "Metric", "Value", "Unit", "Description", order=["ord"])
    assert summary == [
        ("Energy-to-solution", "700.00", "J", "Total energy consumed by the job from start to finish."),
        ("Time-to-solution", "4.00", "s", "Elapsed time for the job."),
        ("Average power", "175.00", "W", "Mean power draw."),
        ("Peak power", "200.00", "W", "Peak power observed at t=4.00s."),
        ("Energy delay product", "2800.00", "J*s", "Energy-delay product."),
        ("Appliance comparison", "11.70", "seconds", "Equivalent to running a light bulb."),
    ]
    cleaned = table(clean_cast(profile.visible()), "Task_0__CPUUtilization_normalized", order=[TIME])
    assert cleaned == [(None,), (0.5,), (None,), (None,)]


def test_energy_branch_and_passthrough(spark):
    metered = frames(
        spark, M=("ElapsedTime double, Energy double", [(0.0, 10.0), (2.0, 14.0), (2.0, 15.0), (5.0, 30.0)])
    )
    rows = table(job_profile(metered).df, TIME, "Energy_used_J", "Energy_Increment_J", "NodePower", order=["Energy_used_J"])
    assert rows == [(0, 10.0, 0.0, None), (2, 14.0, 4.0, 2.0), (2, 15.0, 1.0, None), (5, 30.0, 15.0, 5.0)]
    plain = job_profile(frames(spark, T=("ElapsedTime double, RSS double", [(0.0, 1.0), (1.0, 2.0)])))
    assert table(plain.df, TIME, "Energy_used_J", "NodePower", order=[TIME]) == [(0, None, None), (1, None, None)]
    assert job_metrics(plain.df.where(has_energy_data(plain))).count() == 0


def test_duplicate_and_fractional_times_multiply(spark):
    stacked = frames(
        spark,
        A=("ElapsedTime double, a double", [(0.2, 1.0), (0.9, 2.0), (1.5, 3.0)]),
        B=("ElapsedTime double, b double", [(0.0, 10.0), (0.5, 20.0), (None, 30.0)]),
    )
    aligned = align(prepare(stacked)).df
    rows = table(aligned, TIME, "A__a", "B__b", order=[TIME, "A__a", "B__b"])
    assert rows == [
        (None, None, None),
        (0, 1.0, 10.0),
        (0, 1.0, 20.0),
        (0, 2.0, 10.0),
        (0, 2.0, 20.0),
        (1, 3.0, None),
    ]


def test_strings_and_missing_time(spark):
    stacked = frames(
        spark,
        A=("a double, name string, on boolean", [(1.0, "x", True), (None, None, None), (3.0, "y", False)]),
    )
    filled = fill(align(prepare(stacked))).df
    rows = table(filled, TIME, "A__a", "A__name", "A__on", order=[TIME])
    assert rows == [(0, 1.0, "x", True), (1, 2.0, None, None), (2, 3.0, "y", False)]


def test_null_power_sum_goes_on(spark):
    df = frames(spark, E=("ElapsedTime double, NodePower double", [(0.0, 1.0), (1.0, NAN), (2.0, 5.0)]))
    profile = job_profile(df)
    metrics = job_metrics(profile.df).first()
    assert metrics["energy_to_solution_j"] == 0.0 and math.isnan(metrics["peak_power_w"])


def test_metrics_edges(spark):
    single = job_metrics(job_profile(frames(spark, E=("ElapsedTime double, NodePower double", [(0.0, 100.0)]))).df).first()
    assert single["energy_to_solution_j"] == 0 and single["time_to_solution_s"] == 0
    assert math.isnan(single["average_power_w"]) and math.isnan(single["energy_delay_product"])
    assert single["appliance_name"] == "negligible usage"
    rows = [("a", "g", 0, 9.0, 1.0), ("a", "g", 1, 9.0, NAN), ("a", "g", 2, 9.0, 1.0), ("b", "g", 5, None, None)]
    df = spark.createDataFrame(rows, "file_label string, group_name string, ElapsedTime bigint, NodePower double, Energy_used_J double")
    found = {r["file_label"]: r for r in job_metrics(df).collect()}
    assert found["a"]["energy_to_solution_j"] == 1.0 and found["a"]["peak_power_time_s"] == 0.0
    # no energy at all: figures are missing, not an error
    b = found["b"]
    assert b["energy_to_solution_j"] is None and b["average_power_w"] is None and math.isnan(b["peak_power_w"])


def test_zero_power_quarantine_and_groups(spark):
    schema = "ElapsedTime double, NodePower double, EpochTime double"

    def some(label, group, rows):
        return frame(spark, schema, rows, label, group)

    energy = (
        some("f1_x", "a", [(0.0, 5.0, 1.0), (1.0, -5.0, 1.0)])
        .unionByName(some("f1_x", "b", [(0.0, 5.0, 1.0), (1.0, 6.0, 1.0)]))
        .unionByName(some("f1_x", "c", [(0.0, 7.0, 1.0)]))
        .unionByName(some("f2_x", "a", [(-1.0, 5.0, 1.0)]))
        .unionByName(some("f3_x", "a", [(0.0, 5.0, NAN)]))
        .unionByName(some("f4_x", "a", [(0.0, NAN, 1.0)]))
    )
    stacked = stack({"Energy": energy})
    facts = job_facts(stacked)
    assert table(quarantined_files(facts), "file_label", "reason", order=["file_label"]) == [
        ("f2_x", "invalid_elapsed"),
        ("f3_x", "invalid_epoch"),
    ]
    assert ("f1_x", "a") not in {r[:2] for r in table(surviving_frames(facts), *JOB)}
    first = {tuple(r) for r in job_table(stacked).select(*JOB).distinct().collect()}
    assert first == {("f1_x", "b"), ("f4_x", "a")}
    every = {tuple(r) for r in job_profile(stacked, "all").df.select(*JOB).distinct().collect()}
    assert every == {("f1_x", "b"), ("f1_x", "c"), ("f4_x", "a")}
    with pytest.raises(ValueError):
        prepare(stacked, "some")


def test_dropped_frame_leaves_other_frames(spark):
    stacked = frames(
        spark,
        Energy=("ElapsedTime double, NodePower double", [(0.0, 0.0), (7.0, None)]),
        T=("ElapsedTime double, CurrPower double", [(0.0, 3.0), (1.0, 4.0)]),
    )
    rows = table(job_profile(stacked).df, TIME, "NodePower", order=[TIME])
    assert rows == [(0, 3.0), (1, 4.0)]


def test_power_column_is_chosen_by_presence(spark):
    # The energy dataset exists but has no value: its column is still the one.
    energy = frame(spark, "ElapsedTime double, NodePower double", [(0.0, NAN)], "a_x").unionByName(
        frame(spark, "ElapsedTime double, NodePower double", [(None, 1.0)], "b_x")
    )
    task = frame(spark, "ElapsedTime double, CurrPower double", [(0.0, 2.0)], "b_x").unionByName(
        frame(spark, "ElapsedTime double, CurrPower double", [(0.0, 3.0)], "c_x")
    )
    rows = table(job_profile(stack({"Energy": energy, "T": task})).df.where("ElapsedTime = 0"), "file_label", "NodePower", order=["file_label"])
    assert math.isnan(rows[0][1]) and rows[1:] == [("b_x", None), ("c_x", 3.0)]


def test_clean_ranges(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(10000.0, 2400.9, 4102444800.0, 4294967295.0, "x", 9.5e18), (10000.1, -1.0, 4102444801.0, 4294967296.0, "y", 1.9)]
        + [(v, v, v, v, "z", v) for v in (-1.0, NAN, inf, -inf)],
        "NodePower double, T__CPUFrequency double, T__EpochTime double, T__Pages double, other string, T__RSS double",
    )
    cleaned = clean_cast(df)
    assert dict(cleaned.dtypes) == {
        "NodePower": "float", "T__CPUFrequency": "int", "T__EpochTime": "bigint", "T__Pages": "bigint",
        "other": "string", "T__RSS": "bigint",
    }
    rows = [tuple(r) for r in cleaned.collect()]
    assert rows[0] == (10000.0, 2400, 4102444800, 4294967295, "x", None)
    assert rows[1] == (None, None, None, None, "y", 1)
    assert all(r == (None, None, None, None, "z", None) for r in rows[2:])


def test_rows_multiply_by_counts(spark):
    a = [(float(i % 4), float(i)) for i in range(11)]
    b = [(float(i % 6), float(i)) for i in range(7)]
    stacked = frames(spark, A=("ElapsedTime double, a double", a), B=("ElapsedTime double, b double", b))
    n = [[sum(1 for t, _ in f if t == x) for x in range(6)] for f in (a, b)]
    assert align(prepare(stacked)).df.count() == sum(max(1, x) * max(1, y) for x, y in zip(*n))


def test_text_of_summary_numbers(spark):
    assert spark.range(1).select(fixed2(F.lit(0.125))).first()[0] == "0.12"
    assert rows_of(spark.range(1)) == [(0,)]


def test_text_in_a_ruled_column_is_no_error(spark):
    df = spark.createDataFrame([("x",), ("7.9",), (None,)], "`A__RSS` string")
    cleaned = clean_cast(add_task_derivatives(df)).collect()
    assert sorted((r["A__RSS"], round(r["A__RSS_MB"], 4)) for r in cleaned if r["A__RSS"] is not None) == [(7, 0.0077)]
