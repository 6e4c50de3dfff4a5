"""Per-key processing in order of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import ROWS_PER_TASK, heavy_key_slices, with_slice
from tidemark.schemas import KEY_VALUE_LINE
from tidemark.sources.lines import parse_lines


def parse_keyed(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()):
    """``key,value`` lines to typed rows, handed on as they are.

    The rows are not moved to their keys: nothing is computed per key, so a shuffle
    would change no result.
    """
    return parse_lines(lines, KEY_VALUE_LINE, value=value, keep=keep).rows


def running_state(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Each row with the running count and sum of its key, in order.

    ``order`` starts with a time column and must be total. Keys above
    ``rows_per_task`` are cut into slices of time: each slice runs on its own and
    starts from the totals of the slices before it. Rows of one key and microsecond
    stay together.
    """
    time = order[0]
    rows = df.withColumn("_us", F.unix_micros(F.col(time).cast("timestamp")))
    slices = heavy_key_slices(rows, [key], "_us", rows_per_task)
    rows = with_slice(rows, slices, [key], "_us")
    so_far = (
        Window.partitionBy(key, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    number = F.col(value).cast("bigint")
    running = rows.withColumn("running_count", F.count("*").over(so_far)).withColumn(
        "running_sum", F.coalesce(F.sum(number).over(so_far), F.lit(0))
    )
    if slices is not None:
        before = (
            Window.partitionBy(key)
            .orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        heavy = slices.table.select(F.col(key).alias("_heavy"))
        totals = (
            rows.join(heavy, F.col(key).eqNullSafe(F.col("_heavy")), "left_semi")
            .groupBy(key, "_slice")
            .agg(F.count("*").alias("_n"), F.sum(number).alias("_s"))
            .select(
                F.col(key).alias("_key"),
                F.col("_slice").alias("_at"),
                F.sum("_n").over(before).alias("_count_before"),
                F.sum("_s").over(before).alias("_sum_before"),
            )
        )
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_at"))
        zero = F.lit(0).cast("bigint")
        running = running.join(totals, same, "left").select(
            *df.columns,
            (F.col("running_count") + F.coalesce("_count_before", zero)).alias(
                "running_count"
            ),
            (F.col("running_sum") + F.coalesce("_sum_before", zero)).alias("running_sum"),
        )
    return running.select(*df.columns, "running_count", "running_sum")


def keyed_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """Final count and sum per key; also an updating streaming aggregate."""
    return df.groupBy(key).agg(
        F.count("*").alias("running_count"),
        F.coalesce(F.sum(F.col(value).cast("bigint")), F.lit(0)).alias("running_sum"),
    )
