"""Samples in long form give what stacked frames give, whatever datasets a job has."""

import random

import pytest
from pyspark.sql import functions as F

from jouleloom.keys import JOB, ROW, TIME, is_hidden
from jouleloom.operators import samples as long_form
from jouleloom.operators.align import PREV_TIME, align, fill
from jouleloom.operators.frames import job_facts, stack
from jouleloom.operators.samples import aligned_samples, job_columns, sample_facts, samples_of, usable_samples
from jouleloom.plans.fleet import fleet_profile, fleet_table
from jouleloom.plans.jobs import job_profile, job_table
from jouleloom.plans.segments import prepare
from jouleloom.sources.datasets import RAW_SCHEMA, SHAPED_SCHEMA, TYPED_SCHEMA, dataset_catalog, dataset_columns, frames_from_raw, samples_from_raw
from tests.helpers import frame

DATASETS = {
    "Energy": "ElapsedTime double, NodePower double, EpochTime bigint",
    "a__Tasks": "ElapsedTime double, CPUUtilization double, RSS double, Note string",
    "b": "ElapsedTime double, Energy double, Flag boolean",
}


def random_frames(spark, seed, jobs=3, rows=40, span=15, energy=True):
    rng = random.Random(seed)
    number = lambda: None if rng.random() < 0.5 else round(rng.uniform(-5, 500), 3)
    stacked = {}
    for p, schema in DATASETS.items():
        parts = []
        for j in range(jobs):
            if (p == "Energy" and (j == 1 or not energy)) or (p == "b" and j == 2):
                continue
            made = []
            for _ in range(rng.randint(1, rows)):
                t = None if rng.random() < 0.05 else rng.randint(0, span) + rng.random()
                made.append((t, number(), {"Energy": 1_700_000_000 + rng.randint(0, 999), "a__Tasks": number(), "b": rng.random() < 0.5}[p], *(("x",) if p == "a__Tasks" else ())))
            parts.append(frame(spark, schema, made, f"{j}_f", "g"))
        if parts:
            stacked[p] = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stack(stacked)


def cells(rows, value):
    """(job, place among the rows, time, column) -> value, of rows in order."""
    out, place = {}, {}
    for r in rows:
        key = r["file_label"], r["group_name"]
        n = place[key] = place.get(key, -1) + 1
        out[(*key, n, r[TIME], None)] = None
        for c, v in value(r):
            if v is not None:
                out[(*key, n, r[TIME], c)] = v
    return out


def long_cells(df):
    rows = sorted(df.collect(), key=lambda r: (*(r[j] for j in JOB), r["position"]))
    return cells(rows, lambda r: [*r["values"].items(), *r["texts"].items()])


def wide_cells(timeline):
    order = [F.col(f"`{c}`").asc_nulls_first() for c in (*JOB, *timeline.order.order)]
    names = [c for c in timeline.df.columns if not is_hidden(c) and c not in (*JOB, TIME, PREV_TIME)]
    text = lambda v: str(v).lower() if isinstance(v, bool) else v
    return cells(timeline.df.orderBy(*order).collect(), lambda r: [(c, text(r[c])) for c in names])


def same(got, want):
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if not isinstance(v, float)} == {k: v for k, v in want.items() if not isinstance(v, float)}
    for k, v in want.items():
        if isinstance(v, float):
            assert got[k] == pytest.approx(v, rel=1e-12), k


@pytest.mark.parametrize("seed,limit,gap", [(1, 10**6, 4096), (2, 10**6, 4096), (3, 5, 3), (4, 7, 2)])
def test_rows_equal_those_of_frames(spark, monkeypatch, seed, limit, gap):
    """Times repeat within datasets, are missing, and lie far apart; long jobs and stretches are split."""
    monkeypatch.setattr(long_form, "GAP", gap)
    frames = random_frames(spark, seed)
    same(long_cells(aligned_samples(samples_of(frames), limit)), wide_cells(fill(align(prepare(frames)))))


def test_times_that_do_not_repeat_take_the_short_way(spark):
    frames = stack({p: frame(spark, schema, [(float(3 * i + n), *((i * 1.5 if i % 4 == n else None,) if p == "x" else (float(i),))) for i in range(30)]) for n, (p, schema) in enumerate((("x", "ElapsedTime double, v double"), ("y", "ElapsedTime double, w double")))})
    rows = samples_of(frames)
    timeline, repeated = long_form.timeline_of(rows)
    assert not repeated and timeline.count() == 60
    same(long_cells(aligned_samples(rows)), wide_cells(fill(align(prepare(frames)))))


@pytest.mark.parametrize("energy", [True, False])
def test_profiles_and_tables_equal_those_of_frames(spark, energy):
    frames = random_frames(spark, 7, energy=energy, rows=25)
    common = [TIME, "NodePower", "ElapsedTime_Diff", "Energy_Increment_J", "Energy_used_J"] + (["EpochTime"] if energy else [])

    def plain(df):
        return sorted((tuple(None if v is None else round(float(v), 6) for v in r) for r in df.collect()), key=str)

    assert plain(fleet_profile(samples_of(frames), limit=9).select(*common)) == plain(job_profile(frames).df.select(*common))
    wide, table = job_table(frames, groups="all"), fleet_table(samples_of(frames), groups="all")
    assert plain(table.select(*common)) == plain(wide.select(*common))
    own = [c for c in wide.columns if "__" in c and dict(wide.dtypes)[c] not in ("string", "boolean")]
    want = [(c, None if v is None else round(float(v), 4)) for r in wide.collect() for c, v in ((c, r[c]) for c in own)]
    got = [(c, round(v, 4)) for r in table.collect() for c, v in r["values"].items()]
    assert sorted(got) == sorted(x for x in want if x[1] is not None) and {"a__Tasks__RSS_MB", "a__Tasks__CPUUtilization_normalized"} <= {c for c, _ in got}


def test_facts_choose_files_groups_and_datasets(spark):
    power = "ElapsedTime double, NodePower double, EpochTime double"
    rows = {
        "Energy": [("1_ok", "g0", [(0.0, 0.0, 1.0), (1.0, 0.0, 2.0)]), ("1_ok", "g1", [(0.0, 5.0, 1.0)]), ("2_bad", "g", [(-1.0, 5.0, 1.0)]), ("3_epoch", "g", [(0.0, 5.0, float("inf"))])],
        "Late": [("1_ok", "g0", [(0.0, 5.0, 1.0)]), ("4_zero", "g", [(0.0, -2.0, 1.0), (1.0, 2.0, 1.0)])],
    }
    frames = stack({p: (lambda f: f[0] if len(f) == 1 else f[0].unionByName(f[1]) if len(f) == 2 else f[0].unionByName(f[1]).unionByName(f[2]).unionByName(f[3]))([frame(spark, power, r, a, g) for a, g, r in of]) for p, of in rows.items()})
    got = {tuple(r[j] for j in JOB): r for r in sample_facts(samples_of(frames)).collect()}
    for r in job_facts(frames).collect():
        other = got[tuple(r[j] for j in JOB)]
        assert all(other[c] == r[c] for c in ("n_rows", "t_min", "t_max", "zero_power", "usable", "bad_time", "bad_epoch"))
        assert other["n"] == {p: n for p, n in r["n"].items() if n}
    kept = lambda groups: sorted({(r["file_label"], r["group_name"], r["prefix"]) for r in usable_samples(samples_of(frames), groups).collect()})
    assert kept("all") == [("1_ok", "g0", "Late"), ("1_ok", "g1", "Energy")] and kept("first") == [("1_ok", "g0", "Late")]


def test_columns_are_chosen_by_presence_in_the_order_of_datasets(spark):
    df = samples_of(random_frames(spark, 9))
    chosen = {r["file_label"]: r for r in job_columns(df).collect()}
    assert (chosen["0_f"]["power"], chosen["0_f"]["meter"], chosen["0_f"]["epoch"]) == ("Energy__NodePower", "b__Energy", "Energy__EpochTime")
    assert (chosen["1_f"]["power"], chosen["1_f"]["meter"], chosen["1_f"]["epoch"]) == (None, "b__Energy", None)
    assert chosen["2_f"]["columns"] == ["Energy__NodePower", "Energy__EpochTime", "a__Tasks__CPUUtilization", "a__Tasks__RSS"]


def test_landed_records_and_arrays(spark):
    late = 2**53 + 1
    rows = [
        ("f", ["g", "meta"], "compound", [TIME, "power", "name", "on"], [3], 0, None, {"power": [1.5, None, 2.5]}, None, {TIME: [0, late, late + 1]}, None, {"name": ["a", None, "c"]}, None, {"on": [True, False, None]}),
        ("f", ["g", "meta"], "compound", [TIME, "power", "name", "on"], [3], 3, None, {"power": [4.0]}, None, {TIME: [7]}, None, {"name": ["d"]}, None, {"on": [False]}),
        ("f", ["g", "plain"], "compound", ["v"], [2], 0, None, {"v": [1.0, 2.0]}, None, None, None, None, None, None),
        ("f", ["g", "one"], "ndarray", [], [3], 0, [5.0, 6.0], None, None, None, None, None, None, None),
        ("f", ["g", "one"], "ndarray", [], [3], 2, [7.0], None, None, None, None, None, None, None),
        ("f", ["g", "two"], "ndarray", [], [2, 2], 0, None, None, [1, 2, 3], None, None, None, None, None),
        ("f", ["g", "two"], "ndarray", [], [2, 2], 3, None, None, [4], None, None, None, None, None),
        ("f", ["g", "words"], "ndarray", [], [-1], 0, None, None, None, None, ["x", "y"], None, None, None),
        ("f", ["g", "none"], "compound", ["v"], [0], 0, None, {"v": []}, None, None, None, None, None, None),
    ]
    raw = spark.createDataFrame(rows, TYPED_SCHEMA)
    got = {}
    for r in samples_from_raw(raw).collect():
        got.setdefault(r["prefix"], []).append((r[ROW], r[TIME], r["bad_time"], [tuple(c) for c in r["cells"]], [tuple(c) for c in r["texts"]]))
    assert sorted(got["meta"]) == [
        (0, 0, False, [(1, "power", 1.5)], [(2, "name", "a"), (3, "on", "true")]), (1, late, False, [(1, "power", None)], [(2, "name", None), (3, "on", "false")]),
        (2, late + 1, False, [(1, "power", 2.5)], [(2, "name", "c"), (3, "on", None)]), (3, 7, False, [(1, "power", 4.0)], [(2, "name", "d"), (3, "on", "false")]),
    ]
    assert sorted(got["plain"]) == [(i, i, False, [(0, "v", i + 1.0)], []) for i in (0, 1)]
    assert sorted(got["one"]) == [(i, i, False, [(0, "value", 5.0 + i)], []) for i in range(3)]
    assert sorted(got["two"]) == [(0, 0, False, [(0, "col_0", 1.0), (1, "col_1", 2.0)], []), (1, 1, False, [(0, "col_0", 3.0), (1, "col_1", 4.0)], [])]
    assert sorted(got["words"]) == [(0, 0, False, [], [(0, "value", "x")]), (1, 1, False, [], [(0, "value", "y")])] and "none" not in got
    numbers = raw.select(*[c.split()[0] for c in RAW_SCHEMA.split(", ")]).where("kind = 'compound' and path_parts[1] = 'plain'")
    same(long_cells(aligned_samples(samples_from_raw(numbers))), wide_cells(fill(align(prepare(frames_from_raw(numbers))))))


def test_fields_with_a_shape_become_columns(spark):
    """In frames and in samples; matrices row by row, chunks of several records, and the field missing in one file."""
    shapes = {"m": [2, 2], "one": [1], "none": [0]}
    rows = [
        ("f", ["g", "rec"], "compound", [TIME, "m", "x", "one", "tag"], [3], 0, None, {"m": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0], "x": [0.5, None]}, None, {TIME: [0, 5], "one": [7, 8]}, None, {"tag": ["a", "b", "c", "d"]}, None, None, shapes | {"tag": [2]}),
        ("f", ["g", "rec"], "compound", [TIME, "m", "x", "one", "tag"], [3], 2, None, {"m": [9.0, 10.0, 11.0, None], "x": [1.5]}, None, {TIME: [6], "one": [9]}, None, {"tag": ["e", None]}, None, None, shapes | {"tag": [2]}),
        ("h", ["g", "rec"], "compound", [TIME, "x", "none"], [1], 0, None, {"x": [4.0], "none": []}, None, {TIME: [2]}, None, None, None, None, shapes),
    ]
    raw = spark.createDataFrame(rows, SHAPED_SCHEMA)
    columns = dataset_columns(dataset_catalog(raw))["rec"]
    assert set(columns) == {TIME, "m_0", "m_1", "m_2", "m_3", "x", "one_0", "tag_0", "tag_1"}
    assert columns["m_3"] == "num" and columns["one_0"] == "int" and columns["tag_1"] == "text"
    frames = frames_from_raw(raw)
    wide = {(r["file_label"], r[TIME]): r["rec"] for r in frames.df.collect()}
    assert [wide["f", 5.0][c] for c in ("m_0", "m_3", "x", "one_0", "tag_0", "tag_1")] == [5.0, 8.0, None, 8, "c", "d"]
    assert [wide["f", 6.0][c] for c in ("m_2", "m_3", "tag_0", "tag_1")] == [11.0, None, "e", None] and wide["h", 2.0]["m_0"] is None and wide["h", 2.0]["x"] == 4.0
    long = samples_from_raw(raw)
    cells = {(r["file_label"], r[TIME]): {c["metric"]: c["value"] for c in [*r["cells"], *r["texts"]]} for r in long.collect()}
    for key, row in cells.items():
        assert {c: v for c, v in row.items() if v is not None} == {c: (float(v) if isinstance(v, int) else v) for c, v in wide[key].asDict().items() if v is not None}
    same(long_cells(aligned_samples(long)), wide_cells(fill(align(prepare(frames)))))


def test_nothing_gives_nothing(spark):
    frames = random_frames(spark, 11)
    none = frames.with_df(frames.df.limit(0))
    assert fleet_table(samples_of(none)).count() == 0
    assert samples_from_raw(spark.createDataFrame([], TYPED_SCHEMA)).count() == 0


def test_samples_are_made_once(spark, tmp_path):
    """Facts and all that follows come from written samples; whatever made them is not run again."""
    frames = stack({"Energy": spark.range(40).selectExpr("'a_x' file_label", "'g' group_name", "id row_idx", "id * 1.0D ElapsedTime", "id * 0.5D NodePower")})
    samples_of(frames).write.parquet(str(tmp_path / "source"))
    samples = spark.read.parquet(str(tmp_path / "source"))
    used = usable_samples(samples)
    assert used.count() == 40 and not [p for p in used.inputFiles() if "/source/" in p]
    same(long_cells(aligned_samples(used, stored=True)), long_cells(aligned_samples(samples)))
