"""Splitting a job over tasks must not change any result."""

import random
import time

import pytest
from pyspark.sql import functions as F

from jouleloom.operators.align import align, fill
from jouleloom.operators.energy import energy_profile, job_metrics
from jouleloom.operators.frames import stack
from jouleloom.operators.scan import Order, row_positions, scan
from jouleloom.plans.jobs import job_table
from jouleloom.plans.segments import dataset_positions, numbered, prepare
from tests.helpers import rows_of


def random_frames(spark, seed, hot=0, meter=False):
    rng = random.Random(seed)
    power = "Energy" if meter else "NodePower"
    energy, task = [], []
    for label, n in (("a_x", 60), ("b_x", 7), ("c_x", 1)):
        for i in range(n):
            t = rng.randrange(0, 3 * n) + rng.random()
            energy.append((label, "g", i, t, rng.choice([None, rng.uniform(0, 300)])))
            t = None if rng.random() < 0.05 else float(rng.randrange(0, 3 * n))
            task.append((label, "g", i, t, rng.choice([None, None, rng.uniform(0, 9), 5.0]), "s%d" % i))
    for i in range(hot):
        energy.append(("a_x", "g", 1000 + i, 90.0, rng.uniform(0, 300)))
    keys = "file_label string, group_name string, row_idx bigint, ElapsedTime double"
    return stack(
        {
            "Energy": spark.createDataFrame(energy, f"{keys}, {power} double"),
            "T": spark.createDataFrame(task, f"{keys}, RSS double, name string"),
        }
    )


@pytest.mark.parametrize(
    ("hot", "segment_rows", "chunk_rows", "meter"), [(0, 3, 100, False), (0, 10, 100, True), (80, 8, 5, False)]
)
def test_split_jobs_equal_whole_jobs(spark, hot, segment_rows, chunk_rows, meter):
    frames = random_frames(spark, 7, hot, meter)
    whole = prepare(frames)
    split = prepare(frames, segment_rows=segment_rows, chunk_rows=chunk_rows)
    assert not whole.split and split.split and (split.hot is not None) == (hot > 0)
    a, b = energy_profile(fill(align(whole))), energy_profile(fill(align(split)))
    assert rows_of(a.visible()) == rows_of(b.visible())
    assert rows_of(job_metrics(a.df)) == rows_of(job_metrics(b.df))


def test_scan_carries_over_segments(spark):
    rng = random.Random(1)
    data = [("k%d" % (i % 2), i // 10, i, rng.choice([None, rng.uniform(-1, 1)]), i == 33) for i in range(60)]
    df = spark.createDataFrame(data, "k string, s int, t int, v double, f boolean")
    results = {"lags": {"before": "v", "before_t": "t"}, "sums": {"sum": "v"}, "flags": {"any": "f"}}
    whole = scan(df, Order(["k"], ["t"]), position="p", **results)
    split = scan(df, Order(["k"], ["t"], ["s"]), position="p", **results)
    assert rows_of(whole) == rows_of(split)


def test_row_positions_start_at_zero(spark):
    df = spark.createDataFrame([("a", 5), ("a", 3), ("b", 9)], "k string, t int")
    assert rows_of(row_positions(df, Order(["k"], ["t"]), "row_idx")) == [("a", 0, 3), ("a", 1, 5), ("b", 0, 9)]


def test_one_shuffle_for_align_scan_and_energy(spark):
    timeline = energy_profile(fill(align(prepare(random_frames(spark, 3)))))
    plan = timeline.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_numbered_by_sampled_ranges(spark):
    rng = random.Random(2)
    data = [("a" if i % 3 else "b", [rng.choice("xyz"), str(rng.randrange(50)), str(i)]) for i in range(200)]
    df = spark.createDataFrame(data, "k string, path array<string>")
    assert rows_of(numbered(df, ["k"], ["path"], "n")) == rows_of(numbered(df, ["k"], ["path"], "n", limit=10))


def test_dataset_positions_of_split_jobs(spark):
    frames = random_frames(spark, 5, hot=40)
    whole, split = prepare(frames), prepare(frames, segment_rows=6, chunk_rows=4)
    assert split.hot is not None
    assert rows_of(dataset_positions(whole)) == rows_of(dataset_positions(split))


def test_order_of_a_split_time_is_that_of_the_whole(spark):
    """Two crowded datasets that straddle chunk borders, and a third that is interpolated across them."""
    rng = random.Random(4)
    keys = "file_label string, group_name string, row_idx bigint, ElapsedTime double"
    crowd = {n: [("a_x", "g", i, float(i // 6 * 5), rng.uniform(0, 9)) for i in range(24)] for n in ("RSS", "ReadMB")}
    sparse = [("a_x", "g", i, float(i), rng.uniform(0, 300)) for i in range(0, 20, 7)]
    frames = stack(
        {
            "A": spark.createDataFrame(crowd["RSS"], f"{keys}, RSS double"),
            "Energy": spark.createDataFrame(sparse, f"{keys}, NodePower double"),
            "B": spark.createDataFrame(crowd["ReadMB"], f"{keys}, ReadMB double"),
        }
    )
    whole = fill(align(prepare(frames)))
    for chunk_rows in (1, 4, 9, 50):
        split = prepare(frames, segment_rows=2, chunk_rows=chunk_rows)
        assert split.hot is not None
        assert rows_of(fill(align(split)).visible()) == rows_of(whole.visible())


def test_time_to_align_grows_with_rows_per_time(spark):
    def seconds(n):
        rows = spark.range(n).selectExpr("'a_x' file_label", "'g' group_name", "id row_idx", "1.0D ElapsedTime", "id * 0.5D NodePower")
        began = time.perf_counter()
        assert align(prepare(stack({"Energy": rows}))).df.count() == n
        return time.perf_counter() - began

    seconds(1_000)
    small = min(seconds(10_000) for _ in range(2))
    assert seconds(40_000) < 6 * small


def test_later_groups_do_not_spoil_the_first(spark):
    keys = "file_label string, group_name string, row_idx bigint, ElapsedTime double, NodePower double"
    rows = [("a_x", "g0", 0, 0.0, 5.0), ("a_x", "g0", 1, 1.0, 6.0), ("a_x", "g1", 0, -1.0, 5.0), ("b_x", "g0", 0, -1.0, 5.0), ("b_x", "g1", 0, 1.0, 5.0)]
    frames = stack({"Energy": spark.createDataFrame(rows, keys)})
    assert [r["file_label"] for r in job_table(frames).collect()] == ["a_x", "a_x"]
    assert job_table(frames, groups="all").count() == 0


def test_an_outlier_leaves_segments_balanced(spark):
    keys = "file_label string, group_name string, row_idx bigint, ElapsedTime double, NodePower double"
    rows = [("a_x", "g", i, float(i), 5.0) for i in range(1999)] + [("a_x", "g", 1999, 1.7e9, 5.0)]
    frames = stack({"Energy": spark.createDataFrame(rows, keys)})
    split = prepare(frames, segment_rows=100)
    sizes = [r["count"] for r in split.frames.df.groupBy("seg_id").count().collect()]
    assert split.hot is None and max(sizes) < 300 and len(sizes) <= 20
    whole = energy_profile(fill(align(prepare(frames))))
    assert rows_of(energy_profile(fill(align(split))).visible()) == rows_of(whole.visible())


def test_a_split_plan_reads_its_source_once(spark, tmp_path):
    frames = random_frames(spark, 3)
    frames.df.write.parquet(str(tmp_path / "source"))
    stored = frames.with_df(spark.read.schema(frames.df.schema).parquet(str(tmp_path / "source")))
    timeline = energy_profile(fill(align(prepare(stored, segment_rows=10))))
    plan = timeline.df._jdf.queryExecution().optimizedPlan().treeString()
    files = [p for p in timeline.df.inputFiles() if "/source/" in p]
    assert len(set(files)) == len(list((tmp_path / "source").glob("*.parquet")))
    leaves = timeline.df._jdf.queryExecution().executedPlan().toString()
    assert leaves.count("/source") <= 1, plan


def test_small_segments_take_no_task_each(spark, monkeypatch):
    """Segments of a few rows are cut from ranges as large as a task takes."""
    keys = "file_label string, group_name string, row_idx bigint, ElapsedTime double, NodePower double"
    rows = [(f"{j}_x", "g", i, float(i // 2), i * 0.5) for j in range(20) for i in range(50)]
    frames = stack({"Energy": spark.createDataFrame(rows, keys)})
    kind = type(frames.df)
    asked, plain = [], kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda df, n, *by: asked.append(n) or plain(df, n, *by))
    split = prepare(frames, segment_rows=4)
    assert asked == [1] and split.hot is None
    sizes = [r["count"] for r in split.frames.df.groupBy("file_label", "seg_id").count().collect()]
    assert len(sizes) >= 20 * 12 and max(sizes) <= 5
    times = split.frames.df.groupBy("file_label", "ElapsedTime").agg(F.count_distinct("seg_id").alias("n"))
    assert times.where("n > 1").isEmpty()
    assert rows_of(fill(align(split)).visible()) == rows_of(fill(align(prepare(frames))).visible())
