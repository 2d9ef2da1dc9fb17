from jouleloom.functions.appliance import with_appliance
from jouleloom.functions.numbers import fixed2, is_finite, nan, round_half_even, truncate_to_long
from jouleloom.functions.text import (
    dataset_prefix,
    file_stem,
    job_id,
    mask_secret,
    normalize_prefix,
    object_name_is_valid,
    sanitize_object_name,
    storage_key,
    table_name,
    unit_name,
)

__all__ = [
    "dataset_prefix",
    "file_stem",
    "fixed2",
    "is_finite",
    "job_id",
    "mask_secret",
    "nan",
    "normalize_prefix",
    "object_name_is_valid",
    "round_half_even",
    "sanitize_object_name",
    "storage_key",
    "table_name",
    "truncate_to_long",
    "unit_name",
    "with_appliance",
]
