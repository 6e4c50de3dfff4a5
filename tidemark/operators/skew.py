"""Cutting the time line of heavy keys into slices that fit one task each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 5_000_000


class Slices(NamedTuple):
    """``table`` has ``(keys, _origin, _width)`` in microseconds. ``even`` says that
    no slice holds more rows than asked for; else copies of one key and time do."""

    table: DataFrame
    even: bool


def heavy_key_slices(
    points: DataFrame,
    keys: Sequence[str],
    micros: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> Slices | None:
    """Slices for the keys above ``rows_per_task``, None where no key is that heavy.

    At most ``rows / rows_per_task`` keys can be, which bounds the table. The width
    starts at half the average need and shrinks, where time is crowded, until no slice
    has more distinct times than rows asked for. Every pass counts, and combines the
    counts before they are shuffled.
    """
    points = points.select(*keys, micros)
    spark = points.sparkSession
    counts = points.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.min(micros).alias("_origin"),
        F.max(micros).alias("_end"),
    )
    span = F.col("_end") - F.col("_origin") + 1
    parts = F.ceil(F.col("_n") * 2 / F.lit(rows_per_task))
    timed = (F.col("_n") > rows_per_task) & F.col("_origin").isNotNull()
    heavy = counts.filter(timed).select(
        *keys, "_origin", _at_least_one(F.call_function("div", span, parts)).alias("_width")
    )
    rows = heavy.collect()
    if not rows:
        return None
    slices = spark.createDataFrame(rows, heavy.schema)

    def fits() -> bool:
        fullest = _fullest(points, slices, keys, micros).agg(F.max("_n")).first()[0]
        return fullest <= rows_per_task

    if fits():
        return Slices(slices, True)
    times = points.distinct()
    again = True
    while again:
        fullest = _fullest(times, slices, keys, micros)
        too_full = (F.col("_n") > rows_per_task) & (F.col("_width") > 1)
        share = F.ceil(F.col("_n") * 2 / F.lit(rows_per_task))
        narrower = _at_least_one(F.call_function("div", F.col("_width"), share))
        refined = fullest.select(
            *keys,
            "_origin",
            F.when(too_full, narrower).otherwise(F.col("_width")).alias("_width"),
            too_full.alias("_again"),
        ).collect()
        slices = spark.createDataFrame([row[:-1] for row in refined], heavy.schema)
        again = any(row["_again"] for row in refined)
    return Slices(slices, fits())


def _at_least_one(number: Column) -> Column:
    return F.greatest(number, F.lit(1)).cast("bigint")


def _fullest(
    points: DataFrame, slices: DataFrame, keys: Sequence[str], micros: str
) -> DataFrame:
    """Rows ``_n`` in the fullest slice of each heavy key."""
    by = [*keys, "_origin", "_width"]
    placed = _null_safe_join(points, slices, keys, "inner").withColumn("_slice", _place(micros))
    per_slice = placed.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    return per_slice.groupBy(*by).agg(F.max("_n").alias("_n"))


def _null_safe_join(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys, NULL being a key like any other. The table of heavy keys is a
    local relation, whose size Spark knows."""
    named = table.withColumnsRenamed({key: f"_heavy_{key}" for key in keys})
    on = [F.col(key).eqNullSafe(F.col(f"_heavy_{key}")) for key in keys]
    return df.join(named, reduce(and_, on), how).drop(*[f"_heavy_{key}" for key in keys])


def _place(micros: str) -> Column:
    offset = F.col(micros) - F.col("_origin")
    return F.call_function("div", offset, F.col("_width"))


def with_slice(
    df: DataFrame, slices: Slices | None, keys: Sequence[str], micros: str
) -> DataFrame:
    """Add ``_slice``: the place on the time line of a heavy key, 0 for other keys."""
    if slices is None:
        return df.withColumn("_slice", F.lit(0).cast("bigint"))
    placed = _null_safe_join(df, slices.table, keys, "left")
    place = F.coalesce(_place(micros), F.lit(0)).cast("bigint")
    return placed.withColumn("_slice", place).drop("_origin", "_width")
