"""Tumbling windows per key. They run alike on batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_ms_text
from tidemark.operators.accumulate import average


def tumbling_sum_with_start(
    df: DataFrame, key: str, value: str, time: str, size: str = "5 seconds"
) -> DataFrame:
    """``(key, sum, window_start)``, the start as epoch milliseconds in text."""
    sums = df.groupBy(key, F.window(time, size).alias("_w")).agg(
        F.sum(F.col(value).cast("bigint")).alias("sum")
    )
    return sums.select(key, "sum", epoch_ms_text(F.col("_w.start")).alias("window_start"))


def tumbling_sum(
    df: DataFrame, key: str, value: str, time: str, size: str = "5 seconds"
) -> DataFrame:
    """``(key, sum)``, one row per key and window."""
    return tumbling_sum_with_start(df, key, value, time, size).select(key, "sum")


def tumbling_average_with_start(
    df: DataFrame, key: str, value: str, time: str, size: str = "5 seconds"
) -> DataFrame:
    """``(key, window_start, average)``."""
    accumulator = average(value)
    window = F.window(time, size).alias("_w")
    averages = accumulator.finished(accumulator.partial(df, [key, window]), [key, "_w"])
    return averages.select(
        key, epoch_ms_text(F.col("_w.start")).alias("window_start"), "average"
    )


def tumbling_average(
    df: DataFrame, key: str, value: str, time: str, size: str = "5 seconds"
) -> DataFrame:
    """``(key, average)``, one row per key and window."""
    return tumbling_average_with_start(df, key, value, time, size).select(key, "average")
