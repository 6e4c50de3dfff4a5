"""Time conversions: epoch milliseconds, local wall-clock text, arrival time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"


def epoch_ms_to_timestamp(epoch_ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, cut to whole seconds."""
    return F.timestamp_seconds(F.call_function("div", epoch_ms, F.lit(1000)))


def local_text_to_timestamp(text: Column, zone: str = "+08:00") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` wall-clock text of ``zone`` to an instant.

    The session zone must be UTC. Text of another form gives NULL.
    """
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(WALL_CLOCK)), zone)


def local_text_to_epoch_ms(text: Column, zone: str = "+08:00") -> Column:
    return F.unix_millis(local_text_to_timestamp(text, zone))


def epoch_ms_text(moment: Column) -> Column:
    """A timestamp as epoch milliseconds in decimal text."""
    return F.unix_millis(moment).cast("string")


def with_processing_time(
    df: DataFrame, name: str = "proctime", at: Column | None = None
) -> DataFrame:
    """Add the arrival time: the clock, or ``at`` so that a replay is repeatable.

    The clock is read once per batch or micro-batch.
    """
    return df.withColumn(name, F.current_timestamp() if at is None else at)
