"""Sliding windows on streams, put together from panes.

A pane is as long as the slide. Events are summed into their pane first, a row each, and
only the panes are copied to the windows that they are part of. Distinct values go the same
way: once a pane, then once a window, by Spark's own aggregate and deduplication, whose
state goes with the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_windows(summed: DataFrame, slide_seconds: int, panes: int) -> DataFrame:
    """Sums of panes ``_pane`` for each window that they are part of, by its ``_time``, the
    last microsecond in it."""
    placed = summed.withColumn("_at", F.window_time("_pane"))
    window = F.window("_at", f"{slide_seconds * panes} seconds", f"{slide_seconds} seconds")
    placed = placed.withColumn("_window", window).withColumn("_time", F.window_time("_window"))
    return placed.drop("_pane", "_at", "_window")


def entries(
    placed: DataFrame, keys: list[str], counters: dict[str, str], slide_seconds: int, panes: int
) -> DataFrame:
    """``(keys, _time, _counter)``: a row for each window and each distinct value in it.

    ``counters`` maps columns to the names under which their values are counted; NULL is no
    value. A value's panes come first, however often it is in them. The state is spread over
    (keys, value), not over keys.
    """
    values = [
        F.when(
            F.col(value).isNotNull(),
            F.struct(F.lit(counter).alias("counter"), F.col(value).cast("string").alias("value")),
        )
        for value, counter in counters.items()
    ]
    seen = placed.select(*keys, "_pane", F.explode(F.array_compact(F.array(*values))).alias("_seen"))
    seen = seen.select(*keys, "_pane", F.col("_seen.counter").alias("_counter"), F.col("_seen.value").alias("_value"))
    seen = seen.groupBy(*keys, "_counter", "_value", "_pane").agg(F.count("*").alias("_n")).drop("_n")
    entered = in_windows(seen, slide_seconds, panes)
    if panes > 1:
        entered = entered.dropDuplicates([*keys, "_counter", "_value", "_time"])
    return entered.select(*keys, "_time", "_counter")
