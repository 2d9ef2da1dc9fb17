"""Containers of a folder tree as a data source, so that nothing has to be listed on the driver.

`spark.read.format("containers").load(root)` has one row per file whose name ends as a container's does, those
of length zero included, which Spark's own listing leaves out: its label, path, length, time, and the reason why it
can't be read, if any. Every folder right below the root is a partition, listed and probed where it is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed value: the first eight bytes of a container.
SIGNATURE = bytes.fromhex("894844460D0A1A0A")
SUFFIX = ".h5"
COLUMNS = "file_label string, path string, length bigint, modificationTime timestamp, reason string"


class Containers(DataSource):
    """Options: path, the root; suffix; depth, the levels of folders that become partitions (1)."""

    @classmethod
    def name(cls) -> str:
        return "containers"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> Folders:
        return Folders(self.options["path"], self.options.get("suffix", SUFFIX), int(self.options.get("depth", "1")))


class Folder(InputPartition):
    def __init__(self, path: str, recursive: bool):
        self.path, self.recursive = path, recursive


class Folders(DataSourceReader):
    def __init__(self, root: str, suffix: str, depth: int):
        self.root, self.suffix, self.depth = root, suffix, depth

    def partitions(self) -> list[Folder]:
        """The folders of the first levels by themselves, and all below each folder of the last level."""
        from pyarrow import fs

        system, at = file_system(self.root)
        out, level = [], [at]
        for _ in range(self.depth):
            out += [Folder(p, False) for p in level]
            found = (i for p in level for i in system.get_file_info(fs.FileSelector(p)))
            level = sorted(i.path for i in found if i.type == fs.FileType.Directory)
        return out + [Folder(p, True) for p in level]

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs

        system, _ = file_system(self.root)
        listed = system.get_file_info(fs.FileSelector(partition.path, recursive=partition.recursive))
        # Paths are told as Spark's own listings tell them, but for local files, which have no scheme here.
        scheme = re.match(r"(?!file:)[a-z0-9]+://", self.root)
        start = scheme[0] if scheme else ""
        for info in sorted(listed, key=lambda i: i.path):
            name = info.path.rpartition("/")[2]
            if info.type == fs.FileType.File and name.endswith(self.suffix):
                yield name[: -len(self.suffix)] or name, start + info.path, info.size, info.mtime, probe(system, info.path, info.size)


def file_system(path: str):
    """The file system of a path, and its name there; names are taken as they are, percent signs included."""
    from pyarrow import fs

    found = re.match(r"([a-z][a-z0-9]*):(?://([^/]*))?(/.*)?$", path, re.S)
    if found is None or found[1] == "file":
        return fs.LocalFileSystem(), "/" + (found[3] if found else path).lstrip("/")
    scheme = "s3" if found[1] in ("s3a", "s3n") else found[1]
    system, base = fs.FileSystem.from_uri(f"{scheme}://{found[2] or ''}/")
    return system, base.rstrip("/") + (found[3] or "")


def probe(system, path: str, size: int) -> str | None:
    """Why a file is no container: eight bytes are read at a few places, never the whole file.

    The signature may stand at byte 0, 512, 1024, 2048 and so on.
    """
    if not size:
        return "empty"
    try:
        with system.open_input_file(path) as f:
            at = 0
            while at + len(SIGNATURE) <= size:
                if f.read_at(len(SIGNATURE), at) == SIGNATURE:
                    return None
                at = at * 2 if at else 512
    except OSError:
        return "unreadable"
    return "not_hdf5"


def container_files(spark: SparkSession, root: str, keep_batch_files: bool = False, **options: str) -> DataFrame:
    """All containers under `root`, any depth, and what is wrong with them."""
    spark.dataSource.register(Containers)
    found = spark.read.format("containers").options(**options).load(root)
    return found if keep_batch_files else found.where("NOT contains(file_label, 'batch')")
