"""From containers to tables: discovery, quarantine, tables whose schema changes, counts, a stream without leftovers."""

import csv
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.keys import TIME
from jouleloom.operators.frames import stack
from jouleloom.plans.files import tables_of_files, write_build, write_tables
from jouleloom.plans.jobs import Build, job_report, job_table
from jouleloom.session import intermediates, tune, written
from jouleloom.sinks.named import NamedFiles, write_report_files
from jouleloom.sinks.registry import merged, read_registry, readable_as, unified
from jouleloom.sinks.tables import read_jobs, register_job_function, write_jobs
from jouleloom.sources.containers import SIGNATURE, container_files
from jouleloom.streaming.intake import stream_jobs
from tests.helpers import frame, table


def container(folder: Path, name: str, content: bytes = SIGNATURE):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content)


def test_every_container_is_listed_with_what_is_wrong(spark, tmp_path):
    for name, content in (("1_a.h5", SIGNATURE), ("x/2_b.h5", b"\0" * 512 + SIGNATURE), ("x/y/z/3_c.h5", b"no container at all"), ("x/y/4_batch.h5", SIGNATURE), ("u/5_e.h5", b""), ("u/6.csv", b""), ("u/.h5", SIGNATURE)):
        container(tmp_path, name, content)
    found = container_files(spark, str(tmp_path))
    rows = {(r["file_label"], Path(r["path"]).name, r["length"], r["reason"]) for r in found.collect()}
    assert rows == {("1_a", "1_a.h5", 8, None), ("2_b", "2_b.h5", 520, None), ("3_c", "3_c.h5", 19, "not_hdf5"), ("5_e", "5_e.h5", 0, "empty"), (".h5", ".h5", 8, None)}
    assert found.rdd.getNumPartitions() == 3 and container_files(spark, str(tmp_path), depth="2").rdd.getNumPartitions() == 4
    assert container_files(spark, f"file://{tmp_path}", keep_batch_files=True).where("file_label = '4_batch'").count() == 1
    assert {str(Path(r["path"]).relative_to(tmp_path)) for r in found.collect()} == {"1_a.h5", "x/2_b.h5", "x/y/z/3_c.h5", "u/5_e.h5", "u/.h5"}
    (tmp_path / "none").mkdir()
    assert container_files(spark, str(tmp_path / "none")).count() == 0


POWER = "ElapsedTime double, NodePower double"


def landed(spark, files):
    """What was landed for the files, as frames of those that are asked for."""
    parts = [frame(spark, POWER, rows, label) for label, rows in files.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)

    def load(wanted):
        return stack({"Energy": every.join(wanted.select("file_label"), "file_label", "left_semi")})

    return load


def test_every_file_is_in_the_table_or_in_the_quarantine(spark, tmp_path):
    root = tmp_path / "in"
    for name in ("a/1_ok.h5", "b/2_twice.h5", "a/2_twice.h5", "3_late.h5", "4_zero.h5", "5_nothing.h5"):
        container(root, name)
    container(root, "c/6_empty.h5", b"")
    container(root, "c/7_text.h5", b"text")
    good = [(0.0, 5.0), (2.0, 7.0)]
    load = landed(spark, {"1_ok": good, "2_twice": good, "3_late": [(-1.0, 5.0)], "4_zero": [(0.0, 0.0)], "6_empty": good, "9_other": good})
    tables = tables_of_files(spark, str(root), load)
    out = str(tmp_path / "out")
    counts = write_tables(tables, out)
    back = read_jobs(spark, f"{out}/jobs")
    quarantine = spark.read.parquet(f"{out}/quarantine")
    assert counts == {"rows": back.count(), "columns": len(back.columns), "quarantined": quarantine.count()} == {"rows": 4, "columns": len(back.columns), "quarantined": 6}
    assert {r[0] for r in table(back, "file_label")} == {"1_ok", "2_twice"}
    got = {(r["file_label"], Path(r["path"]).parent.name): r["reason"] for r in quarantine.collect()}
    assert got == {("2_twice", "a"): "superseded", ("3_late", "in"): "invalid_elapsed", ("4_zero", "in"): "no_usable_data", ("5_nothing", "in"): "no_data", ("6_empty", "c"): "empty", ("7_text", "c"): "not_hdf5"}
    listed = {r["path"] for r in container_files(spark, str(root)).collect()}
    used = {r["path"] for r in container_files(spark, str(root)).join(quarantine, "path", "left_anti").collect()}
    assert len(listed) == 8 and {Path(p).name for p in used} == {"1_ok.h5", "2_twice.h5"}


def test_types_are_unified():
    names = {n: t for n, t in (("long", T.LongType()), ("int", T.IntegerType()), ("double", T.DoubleType()), ("float", T.FloatType()), ("text", T.StringType()), ("flag", T.BooleanType()))}
    for a, b, c in (("int", "long", "long"), ("float", "double", "double"), ("int", "float", "double"), ("long", "double", "double"), ("long", "text", "text"), ("flag", "int", "text"), ("flag", "flag", "flag")):
        assert unified(names[a], names[b]) == unified(names[b], names[a]) == names[c]
    one, two = T._parse_datatype_string("a int, b string"), T._parse_datatype_string("c double, a bigint")
    assert [(f.name, f.dataType.simpleString()) for f in merged(one, two)] == [("a", "bigint"), ("b", "string"), ("c", "double")]
    assert readable_as(one, merged(one, two)) and not readable_as(two, merged(two, T._parse_datatype_string("c string")))
    with pytest.raises(TypeError):
        unified(T.ArrayType(T.LongType()), T.LongType())


@pytest.mark.parametrize("buckets", [0, 3])
def test_batches_with_other_columns_and_types_read_back_whole(spark, tmp_path, buckets):
    path = str(tmp_path / "jobs")

    def write(schema, *rows):
        write_jobs(spark.createDataFrame(rows, f"file_label string, group_name string, ElapsedTime bigint, {schema}"), path, buckets=buckets)

    def read(*columns):
        return sorted(table(read_jobs(spark, path), "file_label", *columns), key=str)

    write("x int", ("a", "g", 0, 1), ("b", "g", 0, 2))
    write("y string", ("c", "g", 0, "three"))
    assert read("x", "y") == [("a", 1, None), ("b", 2, None), ("c", None, "three")]
    write("x bigint, z float", ("b", "g", 0, 2**40, 0.5))
    assert read("x", "y", "z") == [("a", 1, None, None), ("b", 2**40, None, 0.5), ("c", None, "three", None)]
    assert len(read_registry(spark, path).generations) == 1
    write("x double, z double", ("d", "g", 0, 0.25, 2.0), ("a", "g", 0, 1.5, None))
    assert read("x", "z") == [("a", 1.5, None), ("b", float(2**40), 0.5), ("c", None, None), ("d", 0.25, 2.0)]
    write("y double", ("c", "g", 1, 4.0))
    write("y string", ("d", "g", 1, "five"))
    assert read("x", "y") == [("a", 1.5, None), ("b", float(2**40), None), ("c", None, "4.0"), ("d", None, "five")]
    registry = read_registry(spark, path)
    assert len(registry.generations) == 2 and dict((f.name, f.dataType.simpleString()) for f in registry.schema)["x"] == "double"
    with pytest.raises(Exception):  # noqa: B017 -- not a part of the table
        spark.read.parquet(path).count()
    with pytest.raises(ValueError):
        write_jobs(read_jobs(spark, path), path, buckets=buckets + 1)
    with pytest.raises(FileNotFoundError):
        read_jobs(spark, str(tmp_path / "none"))


def test_labels_of_a_build_share_files(spark, tmp_path):
    path = str(tmp_path / "jobs")
    rows = "file_label string, group_name string, ElapsedTime bigint, x bigint"

    def write(schema, *of, parts=1):
        table_of = spark.createDataFrame(of, schema).coalesce(parts)
        assert write_build(Build(table_of, table_of, table_of), path) == {"rows": len(of), "columns": len(table_of.columns)}

    def read(*columns):
        return sorted(table(read_jobs(spark, path), "file_label", *columns), key=str)

    first = [(f"{i}_a", "g", t, i) for i in range(200) for t in range(2)]
    write(rows, *first, parts=2)
    assert len(list(Path(path).rglob("write-*/**/part-*"))) <= 2
    assert read("ElapsedTime", "x") == sorted(((f, t, x) for f, _, t, x in first), key=str)
    assert spark.read.parquet(path).count() == 400
    for _ in range(2):  # whole labels are replaced, however often; null is one, too
        write(rows, ("7_a", "g", 9, -7), (None, "g", 0, 1), (None, "g", 1, 1), ("", "g", 0, 2))
    kept = [(f, t, x) for f, _, t, x in first if f != "7_a"] + [("7_a", 9, -7), (None, 0, 1), (None, 1, 1), ("", 0, 2)]
    assert read("ElapsedTime", "x") == sorted(kept, key=str)
    with pytest.raises(Exception):  # noqa: B017 -- not replaced rows as well
        spark.read.parquet(path).count()
    write(rows.replace("x bigint", "x string, y int"), ("9_a", "g", 0, "nine", 9))
    write(rows, ("7_a", "g", 1, 70))
    assert read("x", "y") == sorted([(f, str(x), None) for f, _, x in kept if f not in ("7_a", "9_a")] + [("7_a", "70", None), ("9_a", "nine", 9)], key=str)
    assert len(read_registry(spark, path).generations) == 2 and read_jobs(spark, path).columns == ["file_label", "group_name", "ElapsedTime", "x", "y"]
    seen = read("ElapsedTime", "x", "y")
    broken = spark.createDataFrame([("8_a", "g", 0, "no number", 1)], rows.replace("x bigint", "x string, y int"))
    with pytest.raises(Exception):  # noqa: B017 -- whatever the task raises
        write_jobs(broken.withColumn("x", F.col("x").cast("int").cast("string")), path, together=True)
    assert read("ElapsedTime", "x", "y") == seen and not list(Path(path).glob("_making*"))
    with pytest.raises(ValueError):
        write_jobs(broken, path, buckets=2, together=True)


def test_a_table_keeps_its_layout(spark, tmp_path):
    path = str(tmp_path / "jobs")
    for x, together in ((1, False), (2, True)):
        write_jobs(spark.createDataFrame([("a", "g", 0, x)], "file_label string, group_name string, ElapsedTime bigint, x bigint"), path, together=together)
        assert table(read_jobs(spark, path), "file_label", "x") == table(spark.read.parquet(path), "file_label", "x") == [("a", x)]
    nothing = spark.createDataFrame([], "file_label string, group_name string, ElapsedTime bigint")
    write_jobs(nothing, f"{path}-none", together=True)
    assert read_jobs(spark, f"{path}-none").count() == 0


def test_a_job_function_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "jobs")
    both = frame(spark, POWER, [(0.0, 5.0), (1.0, 5.0)], "1_a").unionByName(frame(spark, POWER, [(0.0, 7.0)], "it's"))
    write_jobs(job_table(stack({"Energy": both})), path)
    register_job_function(read_jobs(spark, path))
    assert [r["NodePower"] for r in spark.sql("SELECT * FROM job('1_a') ORDER BY ElapsedTime").collect()] == [5.0, 5.0]
    assert spark.sql('SELECT count(*) AS n FROM job("it\'s")').first()["n"] == 1 and spark.sql("SELECT * FROM job('none')").count() == 0
    asked = spark.sql("SELECT a.NodePower FROM job('1_a') a JOIN job('it''s') b USING (ElapsedTime)")
    assert [r[0] for r in asked.collect()] == [5.0]
    one = spark.sql("SELECT NodePower FROM job('1_a')")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "file_label" in plan.split("PartitionFilters:")[1].split("]")[0]


def leftovers(spark):
    """Names of what lies in the application's folder of intermediates."""
    from jouleloom.session import shared_folder

    folder = Path(shared_folder(spark)) / spark.sparkContext.applicationId
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_intermediates_of_a_scope_are_removed(spark):
    before = leftovers(spark)
    with pytest.raises(RuntimeError), intermediates(spark, "scope") as folder:
        kept = written(spark.range(3).toDF("n"), "inside")
        assert kept.count() == 3 and Path(folder).exists()
        raise RuntimeError
    assert not Path(folder).exists() and leftovers(spark) == before
    with pytest.raises(Exception):  # noqa: B017
        kept.count()


def test_a_stream_changes_its_tables_counts_them_and_leaves_nothing(spark, tmp_path):
    events, out = tmp_path / "events", str(tmp_path / "out")
    events.mkdir()
    prices = spark.createDataFrame([(1700000000, 80.0)], "EpochTime bigint, Price_EUR_per_MWh double")
    schema = POWER + ", EpochTime bigint"
    first = frame(spark, schema, [(0.0, 5.0, 1700000000), (1.0, 6.0, 1700000001)], "x")
    second = {"Energy": frame(spark, schema, [(0.0, 9.0, 1700000000)], "y").unionByName(frame(spark, schema, [(-1.0, 9.0, 0)], "bad")), "Tasks": frame(spark, "ElapsedTime double, RSS double, Note string", [(0.0, 2048.0, "n"), (5.0, None, "m")], "y")}

    def load(objects):
        names = {r["file_label"] for r in objects.collect()}
        return stack({"Energy": first} if "x" in names else second)

    before, queries = leftovers(spark), []
    for i, keys in enumerate((["u/x.h5", "u/x.csv"], ["u/y.h5", "u/bad.h5"])):
        record = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in keys]}
        (events / f"{i}.json").write_text(json.dumps(record))
        queries.append(stream_jobs(spark, str(events), out, str(tmp_path / "cp"), load, prices))
        queries[-1].awaitTermination()
        assert leftovers(spark) == before
    jobs = read_jobs(spark, f"{out}/jobs")
    assert table(jobs, "file_label", TIME, "NodePower", "Tasks__RSS", "Tasks__Note", order=["file_label", TIME]) == [("x", 0, 5.0, None, None), ("x", 1, 6.0, None, None), ("y", 0, 9.0, 2048, "n"), ("y", 5, None, None, "m")]
    counts = spark.read.parquet(f"{out}/counts").orderBy("batch").collect()
    assert [(r["rows"], r["quarantined"]) for r in counts] == [(2, 0), (2, 1)] and counts[1]["columns"] == len(jobs.columns) > counts[0]["columns"]
    assert table(spark.read.parquet(f"{out}/quarantine"), "file_label", "reason") == [("bad", "invalid_elapsed")]
    seen = [{n: r for p in q.recentProgress for n, r in p.observedMetrics.items()} for q in queries]
    assert [(s["notices"]["notices"], s["notices"]["records"]) for s in seen] == [(1, 2), (1, 2)]


def test_reports_are_one_named_file_per_job(spark, tmp_path):
    rng = random.Random(1)
    times = list(range(700))
    rng.shuffle(times)
    schema = POWER + ", EpochTime bigint"
    jobs = frame(spark, schema, [(float(t), float(t % 9), 1700000000 + t) for t in times], "1_a").unionByName(frame(spark, schema, [(0.0, 5.0, 1700000000), (1.0, None, 1700000001)], "it's 50%: b", "g/2"))
    prices = spark.createDataFrame([(1700000000, 80.0), (1700000300, 90.0)], "EpochTime bigint, Price_EUR_per_MWh double")
    report = job_report(stack({"Energy": jobs.repartition(5)}), prices)
    (tmp_path / "combined").mkdir()
    (tmp_path / "combined" / "other.csv").write_text("stays")
    for _ in range(2):
        write_report_files(report, str(tmp_path))
    names = {"1_a__g__combined", "it's 50%: b__g_2__combined"}
    for part, ending in (("combined", ""), ("stats", "_stats"), ("summary", "_summary"), ("prices", "_price")):
        assert {p.name for p in (tmp_path / part).iterdir()} == {f"{n}{ending}.csv" for n in names} | ({"other.csv"} if part == "combined" else set()), part
    with (tmp_path / "combined" / "1_a__g__combined.csv").open() as f:
        rows = list(csv.DictReader(f))
    assert [int(r["ElapsedTime"]) for r in rows] == list(range(700)) and rows[0].keys() == {c for c in report.combined.columns if c not in ("file_label", "group_name")}
    assert [float(r["NodePower"]) for r in rows] == [float(t % 9) for t in range(700)]
    with (tmp_path / "combined" / "it's 50%: b__g_2__combined.csv").open() as f:
        assert [r["Energy__NodePower"] for r in csv.DictReader(f)] == ["5.0", ""]
    with (tmp_path / "summary" / "1_a__g__combined_summary.csv").open() as f:
        assert [r["Metric"] for r in csv.DictReader(f)][:2] == ["Energy-to-solution", "Time-to-solution"]


def test_reports_tell_what_was_written_and_what_was_left_out(spark):
    jobs = frame(spark, POWER, [(0.0, 5.0), (3.0, 5.0)], "1_a").unionByName(frame(spark, POWER, [(-1.0, 5.0)], "2_b")).unionByName(frame(spark, POWER, [(0.0, 0.0)], "3_c"))
    report = job_report(stack({"Energy": jobs}))
    assert report.observed == {"rows": report.combined.count(), "columns": len(report.combined.columns)} and report.observed["rows"] == 2
    assert sorted(map(tuple, report.quarantine.collect())) == [("2_b", "invalid_elapsed"), ("3_c", "no_usable_data")]


def test_nothing_is_visible_before_all_files_are_made(spark, tmp_path):
    spark.dataSource.register(NamedFiles)
    part = tmp_path / "part"
    part.write_text("1\n")
    out = tmp_path / "out"
    rows = [("a.csv", "h\n", [str(part), f"file:{part}"]), ("b.csv", "h\n", [str(part)])]
    schema = "name string, header string, parts array<string>"

    def write(given):
        spark.createDataFrame(given, schema).repartition(2).write.format("named_files").mode("append").save(str(out))

    with pytest.raises(Exception):  # noqa: B017 -- whatever the task raises
        write([*rows, ("c.csv", "h\n", [str(tmp_path / "missing")])])
    assert not out.exists() or not list(out.iterdir())
    write(rows)
    assert {p.name: p.read_text() for p in out.iterdir()} == {"a.csv": "h\n1\n1\n", "b.csv": "h\n1\n"}


def test_files_that_vanish_while_listed_are_reported(spark, tmp_path):
    container(tmp_path, "1_a.h5")
    (tmp_path / "1_a.h5").chmod(0)
    found = {r["file_label"]: r["reason"] for r in container_files(spark, str(tmp_path)).collect()}
    (tmp_path / "1_a.h5").chmod(0o600)
    assert found["1_a"] in (None, "unreadable")  # the owner of the machine reads everything


def test_tasks_follow_bytes(spark):
    """A session of few shuffle partitions still gets tasks of bounded size, whatever the input."""
    few = spark.newSession()
    few.conf.set("spark.sql.shuffle.partitions", "2")
    for key in ("initialPartitionNum", "parallelismFirst"):
        few.conf.unset(f"spark.sql.adaptive.coalescePartitions.{key}")
    rows = tune(few).range(8_000_000).select("id", F.rand(1).alias("v"))
    sizes = [r["n"] for r in rows.repartition("id").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) < 1_200_000
