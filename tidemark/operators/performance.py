"""Per-user task performance over flat change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cdc import created_flag, other_flag


def measures() -> list[Column]:
    """The sums and the newest arrival. Each change event counts, also an update."""
    return [
        F.sum("task_type").alias("sum_task_type"),
        F.sum("creteria_type").alias("sum_creteria_type"),
        F.sum("c_time").alias("sum_time"),
        F.sum(created_flag(F.col("op"))).alias("sum_create"),
        F.sum(other_flag(F.col("op"))).alias("sum_other"),
        F.max("proctime").alias("max_proctime"),
    ]


def task_performance(events: DataFrame) -> DataFrame:
    """Distinct tasks and courses, sums and newest arrival per user, over all events.

    Spark counts the distinct values by (user, value) first and by user second, so a
    user with a large share of the events is spread over many tasks.
    """
    return events.groupBy("user_id").agg(
        F.count_distinct("task_id").alias("task_count"),
        F.count_distinct("course_id").alias("course_count"),
        *measures(),
    )


def recent_events(
    events: DataFrame, reference: Column, minutes: int = 5, time: str = "proctime"
) -> DataFrame:
    """Events from ``minutes`` before the reference time up to it, both included."""
    if minutes < 1:
        raise ValueError("minutes must be at least 1")
    earliest = reference - F.expr(f"INTERVAL {minutes} MINUTES")
    return events.filter(F.col(time).between(earliest, reference))


def task_performance_recent(
    events: DataFrame, reference: Column, minutes: int = 5
) -> DataFrame:
    return task_performance(recent_events(events, reference, minutes))
