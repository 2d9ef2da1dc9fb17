"""Name and text rules as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(path: Column) -> Column:
    """Last path part without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def job_id(label: Column) -> Column:
    """Label up to the first underscore, or the whole label."""
    return F.substring_index(label, "_", 1)


def _join_parts(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("/"), F.lit("_"))), "__")


def dataset_prefix(path_parts: Column) -> Column:
    """Column prefix of a dataset: its path below the group, without empty parts."""
    below = F.when(F.size(path_parts) > 1, F.slice(path_parts, 2, F.size(path_parts))).otherwise(path_parts)
    named = F.filter(below, lambda p: p != "")
    return _join_parts(F.when(F.size(named) > 0, named).otherwise(path_parts))


def sanitize_parts(*parts: Column) -> Column:
    """Parts joined by a double underscore, slashes replaced."""
    return _join_parts(F.array(*parts))


def table_name(label: Column) -> Column:
    return F.concat(F.lit("job_"), sanitize_parts(label))


def normalize_prefix(prefix: Column) -> Column:
    """One leading slash dropped; a non-empty prefix ends with a slash."""
    bare = F.regexp_replace(prefix, "^/", "")
    return F.when((bare != "") & ~bare.endswith("/"), F.concat(bare, F.lit("/"))).otherwise(bare)


def sanitize_object_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")


def object_name_is_valid(safe: Column) -> Column:
    """A sanitised name must not be empty and must not climb out of its folder."""
    return (safe != "") & ~safe.contains("..")


def storage_key(user: Column, safe: Column) -> Column:
    return F.concat_ws("/", user, safe)


def mask_secret(value: Column, visible: int = 4) -> Column:
    return (
        F.when(value.isNull() | (value == ""), "<missing>")
        .when(F.length(value) <= visible, F.repeat(F.lit("*"), F.length(value)))
        .otherwise(F.concat(F.substring(value, 1, visible), F.lit("***")))
    )


def unit_name(unit: Column) -> Column:
    """Unit letter spelled out; an unknown unit stays as it is."""
    return F.when(unit == "s", "seconds").when(unit == "m", "minutes").when(unit == "h", "hours").otherwise(unit)
