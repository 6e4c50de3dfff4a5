"""Joins of two inputs within the same tumbling window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def in_window(df: DataFrame, time: str, size: str) -> DataFrame:
    """Replace the time by ``_window_time``, the last moment of its tumbling window.

    Unlike the window's end that moment still carries a stream's watermark.
    """
    placed = df.withColumn("_window", F.window(time, size))
    return placed.withColumn("_window_time", F.window_time("_window")).drop("_window", time)


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str = "10 seconds",
    how: str = "inner",
    splits: int = 1,
) -> DataFrame:
    """Pairs of the same keys and window; ``left`` also keeps rows without a partner.

    The result carries ``window_end``. On streams both sides need a watermark on
    ``time``. In batch Spark splits heavy (key, window) groups of the sorted join. On
    streams it does not; there ``splits`` deals the left rows of a group out to so
    many tasks, each of which gets the right rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if splits < 1:
        raise ValueError("splits must be at least 1")
    on = [*keys, "_window_time"]
    if splits > 1:
        number = F.pmod(F.xxhash64(*left.columns), F.lit(splits)).cast("int")
        left = left.withColumn("_split", number)
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
        right = right.withColumn("_split", everywhere)
        on.append("_split")
    joined = in_window(left, time, size).join(in_window(right, time, size), on, how)
    end = F.col("_window_time") + F.expr("INTERVAL 1 MICROSECOND")
    return joined.withColumn("window_end", end).drop("_window_time", "_split")


def co_group_apply(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
) -> DataFrame:
    """A function over the pairs of each key and the left rows without a partner.

    The function gets record batches with the keys, the other left columns, the other
    right columns (NULL without a partner) and ``paired``. Batches are cut anywhere, so
    it can neither see nor depend on how many rows a group has. A NULL key has no
    partner. Spark splits heavy keys as in any join.
    """
    marked = right.withColumn("paired", F.lit(True))
    joined = left.join(marked, list(keys), "left")
    joined = joined.withColumn("paired", F.coalesce("paired", F.lit(False)))
    return joined.mapInArrow(lambda batches: map(function, batches), schema)
