"""One file per job, under its own name: CSV parts written in parallel, put together where the files lie.

Rows are laid over the tasks by sampled ranges of (name, order) and written as CSV parts without a header, so no task
holds a whole long job. A second job puts the parts of each name together, byte for byte, one name a task, through a
writer that shows nothing before all of it has succeeded: files are made in a hidden folder and renamed on commit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from jouleloom.keys import JOB, TIME
from jouleloom.operators.prices import EPOCH
from jouleloom.session import intermediates
from jouleloom.sinks.reports import with_export_name
from jouleloom.sources.containers import file_system

#: Bytes copied at once.
COPY = 1 << 20


@dataclass
class Made(WriterCommitMessage):
    """The names a task has made, in its own hidden folder."""

    folder: str
    names: list[str]


class NamedFiles(DataSource):
    """A sink of rows (name, header, parts): each becomes the file `name`, the header followed by the files listed.

    Option `path` is the folder. Files of other names in it stay.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> Joiner:
        return Joiner(self.options["path"])


class Joiner(DataSourceWriter):
    def __init__(self, path: str):
        import uuid

        self.path, self.hidden = path, f"{path}/.making-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Made:
        """A task that is run again, or twice, makes files in a folder of its own."""
        import uuid

        system, folder = file_system(f"{self.hidden}/{uuid.uuid4().hex}")
        system.create_dir(folder, recursive=True)
        names = []
        for row in rows:
            with system.open_output_stream(f"{folder}/{row['name']}") as out:
                out.write(row["header"].encode())
                for part in row["parts"]:
                    source, at = file_system(part)
                    with source.open_input_stream(at) as f:
                        while piece := f.read(COPY):
                            out.write(piece)
            names.append(row["name"])
        return Made(folder, names)

    def commit(self, messages: Sequence[Made | None]) -> None:
        system, path = file_system(self.path)
        for m in messages:
            for name in m.names if m else ():
                system.move(f"{m.folder}/{name}", f"{path}/{name}")
        self.clear()

    def abort(self, messages: Sequence[Made | None]) -> None:
        self.clear()

    def clear(self) -> None:
        system, hidden = file_system(self.hidden)
        if system.get_file_info(hidden).type.name == "Directory":
            system.delete_dir(hidden)


def write_named_csv(df: DataFrame, path: str, name: str, order: Sequence[str] = (), without: Sequence[str] = ()) -> None:
    """One CSV file with a header per value of the column `name`, its rows in the given order.

    Columns in `without` only order the rows. A name must be one of a file. A missing value is an empty field. Replaces files of
    these names, each at once, when all are complete.
    """
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    by = [F.col(f"`{c}`") for c in (name, *order)]
    kept = [c for c in df.columns if c not in (name, *without)]
    header = ",".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if any(x in c for x in ',"\n') else c for c in kept) + "\n"
    with intermediates(spark, "csv-parts") as folder:
        parts = df.repartitionByRange(*by).sortWithinPartitions(*by).select(F.col(f"`{name}`").alias("of~"), *[F.col(f"`{c}`") for c in kept])
        parts.write.partitionBy("of~").option("emptyValue", "").csv(f"{folder}/csv")
        # The names of folders and files only; those of one name are numbered in the order of its ranges.
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/csv").select(F.col("`of~`").cast("string").alias("name"), "path")
        rows = files.groupBy("name").agg(F.array_sort(F.collect_list("path")).alias("parts")).withColumn("header", F.lit(header))
        rows.repartition("name").write.format("named_files").mode("append").save(path)


def write_report_files(report, folder: str) -> None:
    """A report as the files `<file>__<group>__combined.csv`, `..._stats.csv`, `..._summary.csv` and `..._price.csv`, in a folder each."""
    parts = [("combined", report.combined, "", [TIME], []), ("stats", report.stats, "_stats", ["metric"], []), ("summary", report.summary, "_summary", ["ord"], ["ord"])]
    if report.prices is not None:
        parts.append(("prices", report.prices, "_price", [EPOCH], []))
    for name, rows, ending, order, without in parts:
        named = with_export_name(rows, f"{ending}.csv").drop(*JOB)
        write_named_csv(named, f"{folder}/{name}", "export", order, without)
