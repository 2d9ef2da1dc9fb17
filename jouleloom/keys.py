"""Column names shared by all operators."""

JOB = ["file_label", "group_name"]
TIME = "ElapsedTime"
ROW = "row_idx"
SEP = "__"

# Segment columns: present only when a plan splits long jobs (see plans/segments.py).
SEG = "seg_id"
SUB = "seg_sub"


def tie(prefix: str) -> str:
    """Hidden column holding the frame's row index, the order among equal times."""
    return f"tie~{prefix}"


def present(prefix: str) -> str:
    """Hidden column telling that the job has this dataset at all."""
    return f"has~{prefix}"


def is_hidden(column: str) -> bool:
    return column.startswith(("tie~", "has~")) or column in (SEG, SUB)
