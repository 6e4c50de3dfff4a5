"""Task performance as an updating stream with exact distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.performance import measures
from tidemark.streaming.panes import entries, in_windows


def first_sightings(
    events: DataFrame, key: str | Sequence[str], values: dict[str, str], others: Sequence[str]
) -> DataFrame:
    """The events, followed by one row for the first sighting of each (key, value).

    ``values`` maps columns to counters. A counter is 1 on the row of a first sighting
    and 0 elsewhere, so its plain sum is the exact distinct count, which Spark can
    keep up on a stream. The state is spread over (key, value), not over keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    zero = {counter: F.lit(0) for counter in values.values()}
    result = events.select(*keys, *others, *[c.alias(n) for n, c in zero.items()])
    for value, counter in values.items():
        seen = events.filter(F.col(value).isNotNull()).dropDuplicates([*keys, value])
        counters = {**zero, counter: F.lit(1)}
        empty = [F.lit(None).cast(events.schema[name].dataType).alias(name) for name in others]
        row = seen.select(*keys, *empty, *[c.alias(n) for n, c in counters.items()])
        result = result.unionByName(row)
    return result


def streaming_performance(events: DataFrame) -> DataFrame:
    """The columns of ``operators.performance.task_performance``, in update mode.

    State grows with the users and their distinct tasks and courses, as long as the
    stream runs.
    """
    measured = ["task_type", "creteria_type", "c_time", "op", "proctime"]
    rows = first_sightings(
        events, "user_id", {"task_id": "new_task", "course_id": "new_course"}, measured
    )
    return rows.groupBy("user_id").agg(
        F.sum("new_task").alias("task_count"),
        F.sum("new_course").alias("course_count"),
        *measures(),
    )


def recent_performance_stream(
    events: DataFrame, slide_seconds: int = 60, panes: int = 5
) -> DataFrame:
    """The same for the last ``panes`` slides of arrivals, brought up to date every slide.

    One row per user and sliding window of ``proctime``, whose end is ``until``, in append
    mode: a window comes out when the watermark, which ``proctime`` must carry, has passed
    it. Each event goes into one pane; see ``streaming.panes``.
    """
    placed = events.withColumn("_pane", F.window("proctime", f"{slide_seconds} seconds"))
    summed = placed.groupBy("user_id", "_pane").agg(*measures())
    rows = in_windows(summed, slide_seconds, panes)
    counters = {"task_id": "task_count", "course_id": "course_count"}
    entered = entries(placed, ["user_id"], counters, slide_seconds, panes)
    for name in counters.values():
        rows = rows.withColumn(name, F.lit(0).cast("bigint"))
        entered = entered.withColumn(name, (F.col("_counter") == name).cast("bigint"))
    rows = rows.unionByName(entered.drop("_counter"), allowMissingColumns=True)
    totals = rows.groupBy("user_id", F.window("_time", f"{slide_seconds} seconds").alias("_window")).agg(
        *[F.sum(c).alias(c) for c in rows.columns if c not in ("user_id", "_time", "max_proctime")],
        F.max("max_proctime").alias("max_proctime"),
    )
    return totals.select(F.col("_window.end").alias("until"), *totals.columns).drop("_window")


def streaming_performance_approximate(events: DataFrame) -> DataFrame:
    """The same with approximate distinct counts, whose state has a fixed size per user."""
    return events.groupBy("user_id").agg(
        F.approx_count_distinct("task_id").alias("task_count"),
        F.approx_count_distinct("course_id").alias("course_count"),
        *measures(),
    )
