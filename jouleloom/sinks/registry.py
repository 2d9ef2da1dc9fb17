"""The written schema of a job table, which grows and widens as jobs with other datasets come in."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.session import exists

FOLDER = "_schema"
BUCKET = "label_bucket"
WRITE = "label_write"

#: Whole and broken numbers from narrow to wide; a type takes all values of those before it in its row.
WHOLE = ("byte", "short", "integer", "long")
BROKEN = ("float", "double")
#: What files of one type can be read as, so that nothing has to be written anew.
READ_AS = {("byte", "short"), ("byte", "integer"), ("short", "integer"), ("byte", "long"), ("short", "long"), ("integer", "long"), ("float", "double")}


def unified(a: T.DataType, b: T.DataType) -> T.DataType:
    """The one type that takes the values of both: the wider number, double for whole and broken ones, otherwise text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = a.typeName(), b.typeName()
    for row in (WHOLE, BROKEN):
        if set(names) <= set(row):
            return max((a, b), key=lambda t: row.index(t.typeName()))
    if set(names) <= {*WHOLE, *BROKEN}:
        return T.DoubleType()
    if any(isinstance(t, (T.ArrayType, T.MapType, T.StructType)) for t in (a, b)):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both in the order they came up in, each with its unified type."""
    types = {f.name: f.dataType for f in old}
    for f in new:
        types[f.name] = unified(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def readable_as(old: T.StructType, new: T.StructType) -> bool:
    """Whether files of the old schema can be read by the new one."""
    types = {f.name: f.dataType for f in new}
    return all(f.dataType == types[f.name] or (f.dataType.typeName(), types[f.name].typeName()) in READ_AS for f in old)


@dataclass(frozen=True)
class Registry:
    """The schema of every generation of a table; files of a generation can be read by its schema."""

    version: int
    fmt: str
    buckets: int
    generations: tuple[T.StructType, ...]
    #: Whether labels share files, told apart by the number of the write they came with.
    together: bool = False

    @property
    def folders(self) -> tuple[str, ...]:
        return (BUCKET, "file_label") if self.buckets else ("file_label",)

    @property
    def schema(self) -> T.StructType:
        return self.generations[-1]

    def admitting(self, schema: T.StructType) -> Registry:
        """The registry for a table that takes rows of `schema`, too."""
        wider = merged(self.schema, schema)
        if wider == self.schema:
            return self
        kept = self.generations[:-1] if readable_as(self.schema, wider) else self.generations
        return replace(self, version=self.version + 1, generations=(*kept, wider))


def read_registry(spark: SparkSession, path: str) -> Registry | None:
    """The last registry written for a table; None if it has none."""
    if not exists(spark, f"{path}/{FOLDER}"):
        return None
    versions = spark.read.schema("value string, version int").option("wholetext", "true").text(f"{path}/{FOLDER}")
    last = versions.agg(F.max(F.struct("version", "value")).alias("last")).first()["last"]
    if last is None:
        return None
    said = json.loads(last["value"])
    return Registry(last["version"], said["format"], said["buckets"], tuple(T.StructType.fromJson(g) for g in said["generations"]), said.get("together", False))


def write_registry(spark: SparkSession, path: str, registry: Registry) -> None:
    """A version of its own; that of another writer at the same time is an error, not a loss."""
    said = {"format": registry.fmt, "buckets": registry.buckets, "generations": [g.jsonValue() for g in registry.generations], "together": registry.together}
    one = spark.createDataFrame([(json.dumps(said),)], "value string")
    one.coalesce(1).write.mode("errorifexists").text(f"{path}/{FOLDER}/version={registry.version}")


def conformed(df: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """`df` in the types of `schema`, the columns `others` as they are; columns that it lacks are not added, as readers see
    them as null."""
    types = {f.name: f.dataType for f in schema} | {c: df.schema[c].dataType for c in others}
    return df.select(*[F.col(f"`{f.name}`") if f.dataType == types[f.name] else F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name) for f in df.schema])
