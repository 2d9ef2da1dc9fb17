"""Spark-native job telemetry and energy analytics.

Every operator works on all jobs at once: a job is one ``(file_label,
group_name)`` pair, and every function takes and returns DataFrames or Columns.
"""

from jouleloom.keys import JOB, TIME

__all__ = ["JOB", "TIME"]
