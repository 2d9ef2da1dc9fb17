"""Landed datasets of hierarchical containers as rows, catalog and frames.

Landed form, one row per chunk of a dataset: `file_label`, `path_parts` (group first), `kind`
(scalar, ndarray or compound), `field_names`, `shape`, `chunk_offset` (flat element or row number),
`num_values` (scalar and ndarray, row-major), `fields` (compound: name -> values). Whole numbers, text and
flags keep their type in columns of the same kind (TYPED_SCHEMA), which may be left out. A field of a record may
have a shape of its own, in `field_shapes` (name -> shape): its values are those of all records, row-major, and
it becomes the columns `<field>_0`, `<field>_1`, ...
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.numbers import truncate_to_long
from jouleloom.functions.text import dataset_prefix
from jouleloom.keys import JOB, ROW, TIME
from jouleloom.operators.frames import Frames, time_is_valid
from jouleloom.operators.samples import CELL, TEXT
from jouleloom.plans.segments import SEGMENT_ROWS, numbered

RAW_SCHEMA = (
    "file_label string, path_parts array<string>, kind string, field_names array<string>, "
    "shape array<bigint>, chunk_offset bigint, num_values array<double>, fields map<string,array<double>>"
)

#: Type of a value -> columns with the values of an array and of the fields of records, and its SQL type.
TYPES = {
    "num": ("num_values", "fields", "double"),
    "int": ("int_values", "int_fields", "bigint"),
    "text": ("text_values", "text_fields", "string"),
    "flag": ("flag_values", "flag_fields", "boolean"),
}
TYPED_SCHEMA = RAW_SCHEMA + "".join(
    f", {values} array<{kind}>, {fields} map<string,array<{kind}>>" for t, (values, fields, kind) in TYPES.items() if t != "num"
)

#: Shapes of fields, which may be left out, too.
SHAPES = "field_shapes"
SHAPED_SCHEMA = TYPED_SCHEMA + f", {SHAPES} map<string,array<bigint>>"


def field_width(raw: DataFrame, field: Column) -> Column:
    """How many values a record has in a field; null if the field has no shape of its own."""
    if SHAPES not in raw.columns:
        return F.lit(None).cast("bigint")
    shape = F.try_element_at(SHAPES, field)
    return F.when(F.size(shape) > 0, F.aggregate(shape, F.lit(1).cast("bigint"), lambda a, d: a * d))


def field_columns(raw: DataFrame, field: Column) -> Column:
    """(field, column, step, place) of every column that a field becomes."""
    width = field_width(raw, field)

    def of(name: Column, step: Column, place: Column) -> Column:
        return F.struct(field.alias("field"), name.alias("column"), step.cast("bigint").alias("step"), place.cast("bigint").alias("place"))

    some = F.filter(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.coalesce(width, F.lit(1)), F.lit(1)) - 1), lambda i: i < F.coalesce(width, F.lit(1)))
    each = F.transform(some, lambda i: of(F.concat(field, F.lit("_"), i.cast("string")), width, i))
    return F.when(width.isNull(), F.array(of(field, F.lit(1), F.lit(0)))).otherwise(each)


def _group() -> Column:
    return F.col("path_parts")[0].alias("group_name")


def dataset_catalog(raw: DataFrame, limit: int = SEGMENT_ROWS) -> DataFrame:
    """One row per dataset in depth-first order: a group's datasets sort by their path parts."""
    datasets = raw.withColumn("types", _types(raw)).groupBy("file_label", "path_parts").agg(
        *[F.any_value(c).alias(c) for c in ("kind", "field_names", "shape", *([SHAPES] if SHAPES in raw.columns else []))], F.max("types").alias("types")
    )
    named = datasets.select(
        "file_label",
        _group(),
        "path_parts",
        dataset_prefix(F.col("path_parts")).alias("prefix"),
        "kind",
        "field_names",
        "shape",
        "types",
        *([SHAPES] if SHAPES in raw.columns else []),
    )
    ranked = numbered(named, JOB, ["path_parts"], "dataset_ord", limit)
    return ranked.withColumn("dataset_ord", (F.col("dataset_ord") + 1).cast("int"))


def _types(raw: DataFrame) -> Column:
    """Types of the chunk's values: (field, type) of records, and type alone, under "", of an array."""
    found = [F.array().cast("array<struct<field:string,type:string>>")]
    for t, (values, fields, _) in TYPES.items():
        if values in raw.columns:
            found.append(F.when(F.col(values).isNotNull(), F.array(_typed(t)(F.lit("")))))
        if fields in raw.columns:
            found.append(F.transform(F.map_keys(fields), _typed(t)))
    return F.array_sort(F.flatten(F.array_compact(F.array(*found))))


def _typed(kind: str) -> Callable[[Column], Column]:
    return lambda field: F.struct(field.alias("field"), F.lit(kind).alias("type"))


def row_width(shape: Column) -> Column:
    """Number of columns an array becomes: the product of all dimensions but the first."""
    trailing = F.slice(shape, 2, F.greatest(F.size(shape) - 1, F.lit(0)))
    return F.aggregate(trailing, F.lit(1).cast("bigint"), lambda product, d: product * d)


def normalize_ndarray(raw: DataFrame, values: str = "num_values") -> DataFrame:
    """Scalars and arrays as (file_label, path_parts, row_idx, column, value).

    Scalars and one-dimensional arrays have one column, `value`; others `col_0`, `col_1`, ...
    """
    arrays = raw.where(F.col("kind") != "compound").select(
        "file_label",
        "path_parts",
        F.size("shape").alias("dims"),
        row_width(F.col("shape")).alias("width"),
        "chunk_offset",
        F.posexplode(values).alias("pos", "value"),
    )
    flat = F.col("chunk_offset") + F.col("pos")
    numbered = F.concat(F.lit("col_"), (flat % F.col("width")).cast("string"))
    return arrays.select(
        "file_label",
        "path_parts",
        F.floor(flat / F.col("width")).alias(ROW),
        F.when(F.col("dims") <= 1, "value").otherwise(numbered).alias("column"),
        "value",
    )


def _array_rows(raw: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """(job, prefix~, row, columns) of the arrays of one type.

    A chunk of whole rows is cut into them where it is; only rows that lie in two chunks are put together
    by a shuffle.
    """
    values = TYPES[kind][0]
    arrays = raw.where((F.col("kind") != "compound") & (F.size(values) > 0)).withColumn("width~", row_width(F.col("shape")))
    width, offset, size = F.col("width~"), F.col("chunk_offset"), F.size(values)
    whole = (offset % width == 0) & (size % width == 0)
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor(size / width) - 1)
    cells = F.transform(starts, lambda i: F.slice(values, (i * width + 1).cast("int"), width.cast("int")))
    own = arrays.where(whole).select(*JOB, "prefix~", "shape", offset, width, F.posexplode(cells).alias("pos", "cells~"))

    def cell(c: str) -> Column:
        if c == "value":
            return F.when(F.size("shape") <= 1, F.col("cells~")[0])
        at = int(c.removeprefix("col_"))
        return F.when(F.size("shape") > 1, F.get("cells~", F.lit(at)))

    row = (F.floor(F.col("chunk_offset") / F.col("width~")) + F.col("pos")).alias(ROW)
    rows = own.select(*JOB, "prefix~", row, *[cell(c).alias(f"{kind}~{c}") for c in columns])
    pieces = normalize_ndarray(arrays.where(~whole), values).withColumns(
        {"prefix~": dataset_prefix(F.col("path_parts")), "group_name": _group()}
    )
    picked = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"{kind}~{c}") for c in columns]
    return rows.unionByName(pieces.groupBy(*JOB, "prefix~", ROW).agg(*picked)) if picked else rows


def dataset_columns(catalog: DataFrame) -> dict[str, dict[str, str]]:
    """Prefix -> column -> type, in order, over all files; sized by the schema, not by the data.

    A column that is whole in one file and not in another is a number; otherwise different types become
    text.
    """
    compound = F.col("kind") == "compound"
    wide = F.transform(
        F.sequence(F.lit(0).cast("bigint"), row_width(F.col("shape")) - 1),
        lambda i: F.concat(F.lit("col_"), i.cast("string")),
    )
    none = F.lit("")

    def plain(names: Column) -> Column:
        return F.transform(names, lambda c: F.struct(none.alias("field"), c.alias("column"), F.lit(1).cast("bigint").alias("step"), F.lit(0).cast("bigint").alias("place")))

    names = (
        F.when(compound, F.flatten(F.transform("field_names", lambda f: field_columns(catalog, f))))
        .when(F.size("shape") <= 1, plain(F.array(F.lit("value"))))
        .otherwise(plain(wide))
    )
    own = F.filter("types", lambda t: t["field"] == F.col("named.field"))
    listed = (
        catalog.select("prefix", "dataset_ord", "kind", "types", F.posexplode(names).alias("at", "named"))
        .withColumn("type", F.coalesce(F.try_element_at(own, F.lit(1))["type"], F.lit("num")))
        .groupBy("prefix", F.col("named.column").alias("column"))
        .agg(F.min("dataset_ord").alias("ord"), F.min("at").alias("at"), F.collect_set("type").alias("types"))
        .orderBy("ord", "prefix", "at", "column")
    )
    columns: dict[str, dict[str, str]] = {}
    for r in listed.collect():
        found = set(r["types"])
        kind = found.pop() if len(found) == 1 else "num" if found == {"num", "int"} else "text"
        columns.setdefault(r["prefix"], {})[r["column"]] = kind
    return columns


def frames_from_raw(raw: DataFrame, columns: dict[str, dict[str, str]] | None = None) -> Frames:
    """Landed datasets as stacked frames; rows without `ElapsedTime` count as their own time."""
    if columns is None:
        columns = dataset_columns(dataset_catalog(raw))
    named = raw.withColumns({"prefix~": dataset_prefix(F.col("path_parts")), "group_name": _group()})
    every = list(dict.fromkeys(c for names in columns.values() for c in names))
    landed = {t: (values, fields, sql) for t, (values, fields, sql) in TYPES.items() if values in raw.columns}

    # Where a column's values lie: in which field, how far apart, and which of them is its first.
    places = F.map_from_entries(F.transform(F.flatten(F.transform("field_names", lambda f: field_columns(raw, f))), lambda c: F.struct(c["column"], c)))
    shaped = SHAPES in raw.columns

    def values_of(t: str, c: str) -> Column:
        _, fields, sql = landed[t]
        none = F.array().cast(f"array<{sql}>")
        if not shaped:
            return F.coalesce(F.col(fields)[c], none).alias(f"{t}~{c}")
        at = F.try_element_at("places~", F.lit(c))
        values = F.coalesce(F.try_element_at(fields, at["field"]), none)
        step = at["step"]
        rows = F.filter(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.floor(F.size(values) / step), F.lit(1)) - 1), lambda i: i < F.floor(F.size(values) / step))
        picked = F.transform(rows, lambda i: F.get(values, (i * step + at["place"]).cast("int")))
        return F.when(step == 1, values).when(step > 1, picked).otherwise(none).alias(f"{t}~{c}")

    zipped = F.arrays_zip(*[values_of(t, c) for t in landed for c in every])
    records = named.where(F.col("kind") == "compound")
    if shaped:
        records = records.withColumn("places~", places)
    compound = records.select(
        *JOB,
        "`prefix~`",
        "chunk_offset",
        F.array_contains("field_names", F.lit(TIME)).alias("timed~"),
        F.posexplode(zipped).alias("pos", "row~"),
    )
    rows = compound.select(
        *JOB,
        "`prefix~`",
        "`timed~`",
        (F.col("chunk_offset") + F.col("pos")).alias(ROW),
        *[F.col("`row~`")[f"{t}~{c}"].alias(f"{t}~{c}") for t in landed for c in every],
    )
    cells = [c for c in every if c == "value" or c.removeprefix("col_").isdigit()]
    for t in landed:
        arrays = _array_rows(named, t, cells).withColumn("timed~", F.lit(False))
        rows = rows.unionByName(arrays, allowMissingColumns=True)

    def column(c: str, kind: str) -> Column:
        if kind in ("int", "flag"):
            return F.col(f"`{kind}~{c}`")
        sources = [t for t in landed if kind == "text" or t in ("num", "int")]
        return F.coalesce(*[F.col(f"`{t}~{c}`").cast(TYPES[kind][2]) for t in sources])

    time = column(TIME, "num") if TIME in every else F.lit(None).cast("double")
    row_time = F.when(F.col("`timed~`"), time).otherwise(F.col(ROW).cast("double"))
    kept = {p: {c: kind for c, kind in names.items() if c != TIME} for p, names in columns.items()}
    kept = {p: names for p, names in kept.items() if names}
    structs = [
        F.when(F.col("`prefix~`") == p, F.struct(*[column(c, kind).alias(c) for c, kind in names.items()])).alias(p)
        for p, names in kept.items()
    ]
    return Frames(rows.select(*JOB, row_time.alias(TIME), ROW, *structs), tuple(kept))


def samples_from_raw(raw: DataFrame) -> DataFrame:
    """Landed datasets in long form (see `operators/samples.py`): nothing about their columns comes to the driver.

    Records without `ElapsedTime`, and arrays, have the row number as time.
    """
    landed = {t: (values, fields) for t, (values, fields, _) in TYPES.items() if values in raw.columns}
    named = raw.withColumns({"prefix": dataset_prefix(F.col("path_parts")), "group_name": _group(), "path": F.col("path_parts")})
    keys = [*JOB, "path", "prefix"]
    columns = F.flatten(F.transform("field_names", lambda f: field_columns(raw, f)))
    records = named.where(F.col("kind") == "compound").withColumn("columns~", columns)

    def rows_in(fields: str) -> Column:
        """How many records the values of each field make up."""
        def of(name: Column, values: Column) -> Column:
            return F.floor(F.size(values) / F.greatest(F.coalesce(field_width(raw, name), F.lit(1)), F.lit(1))).cast("int")

        return F.coalesce(F.map_values(F.transform_values(fields, of)), F.array().cast("array<int>"))

    longest = F.array_max(F.flatten(F.array(*[rows_in(fields) for _, fields in landed.values()])))
    rows = records.withColumn("rows~", longest).where("`rows~` > 0").withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("`rows~`") - 1)))

    def value(t: str, field: Column, step: Column | None = None, place: Column | None = None) -> Column:
        if t not in landed:
            return F.lit(None).cast(TYPES[t][2])
        at = F.col("pos") if step is None else (F.col("pos") * step + place).cast("int")
        return F.get(F.try_element_at(landed[t][1], field), at)

    def number(field: Column, *at: Column) -> Column:
        return F.coalesce(value("num", field, *at), value("int", field, *at).cast("double"))

    def text(field: Column, *at: Column) -> Column:
        return F.coalesce(value("text", field, *at), value("flag", field, *at).cast("string"))

    def listed(kind: str, of: Callable[..., Column], *types: str) -> Column:
        """The record's columns of these types; a field that is missing here may be there in another row."""
        known = F.flatten(F.array(*[F.coalesce(F.map_keys(landed[t][1]), F.array().cast("array<string>")) for t in types if t in landed] or [F.array().cast("array<string>")]))
        cells = F.transform("columns~", lambda c, at: F.struct(at.alias("at"), c["column"].alias("metric"), of(c["field"], c["step"], c["place"]).alias("value"), c["field"].alias("field")))
        kept = F.filter(cells, lambda c: (c["field"] != TIME) & F.array_contains(known, c["field"]))
        return F.transform(kept, lambda c: F.struct(c["at"], c["metric"], c["value"])).cast(f"array<{kind}>")

    timed = F.array_contains("field_names", F.lit(TIME))
    seconds = number(F.lit(TIME))
    whole = value("int", F.lit(TIME))
    exact = F.when(whole >= 0, whole).otherwise(F.when(time_is_valid(seconds), truncate_to_long(seconds)))
    row = F.col("chunk_offset") + F.col("pos")
    of_records = rows.select(
        *keys, row.alias(ROW), F.when(timed, exact).otherwise(row).alias(TIME), F.when(timed, ~time_is_valid(seconds)).otherwise(False).alias("bad_time"),
        listed(CELL, number, "num", "int").alias("cells"), listed(TEXT, text, "text", "flag").alias("texts"),
    )
    out = of_records
    for t, (values, _) in landed.items():
        of_type = _array_samples(named.where((F.col("kind") != "compound") & (F.size(values) > 0)), t, values, keys)
        out = out.unionByName(of_type)
    return out


def _array_samples(arrays: DataFrame, kind: str, values: str, keys: list[str]) -> DataFrame:
    """Rows of the arrays of one type; only rows that lie in two chunks are put together by a shuffle."""
    width, offset, size = F.col("width~"), F.col("chunk_offset"), F.size(values)
    arrays = arrays.withColumn("width~", row_width(F.col("shape"))).withColumn("flat~", F.size("shape") <= 1)
    whole = (offset % width == 0) & (size % width == 0)
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor(size / width) - 1)
    cut = F.transform(starts, lambda i: F.slice(values, (i * width + 1).cast("int"), width.cast("int")))
    own = arrays.where(whole).select(*keys, "flat~", (offset / width).cast("bigint").alias("first"), F.posexplode(cut).alias("pos", "row"))
    own = own.select(*keys, "flat~", (F.col("first") + F.col("pos")).alias(ROW), F.transform("row", lambda v, i: F.struct(i.alias("i"), v.alias("v"))).alias("row"))
    flat = F.col("chunk_offset") + F.col("pos")
    split = arrays.where(~whole).select(*keys, "flat~", "width~", "chunk_offset", F.posexplode(values).alias("pos", "v"))
    split = split.groupBy(*keys, "flat~", F.floor(flat / width).alias(ROW)).agg(
        F.array_sort(F.collect_list(F.struct((flat % width).cast("int").alias("i"), F.col("v")))).alias("row")
    )
    name = lambda i: F.when(F.col("flat~"), F.lit("value")).otherwise(F.concat(F.lit("col_"), i.cast("string")))
    to = "double" if kind in ("num", "int") else "string"
    cells = F.transform("row", lambda c: F.struct(c["i"].alias("at"), name(c["i"]).alias("metric"), c["v"].cast(to).alias("value")))
    none = {k: F.array().cast(f"array<{k}>") for k in (CELL, TEXT)}
    is_number = to == "double"
    return own.unionByName(split).select(
        *keys, ROW, F.col(ROW).alias(TIME), F.lit(False).alias("bad_time"),
        (cells.cast(f"array<{CELL}>") if is_number else none[CELL]).alias("cells"), (none[TEXT] if is_number else cells.cast(f"array<{TEXT}>")).alias("texts"),
    )
