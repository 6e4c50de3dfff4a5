"""Latest non-null values, first and last times per key.

The work goes through one mergeable state per column, the largest
``(order, value)`` pair, so that partial results of map tasks or of micro-batches
combine in any grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_states(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    times: dict[str, str] | None = None,
) -> DataFrame:
    """State per key: newest (order, value) of each column, first and last times.

    ``times`` maps a time column to a prefix: ``{"proctime": "p"}`` adds ``p_min``
    and ``p_max``.
    """
    if not order:
        raise ValueError("an explicit order is needed to say what is latest")
    position = [F.col(name).alias(f"o{i}") for i, name in enumerate(order)]
    states = [
        F.max(
            F.when(F.col(v).isNotNull(), F.struct(*position, F.col(v).alias("value")))
        ).alias(v)
        for v in values
    ]
    spans = []
    for time, prefix in (times or {}).items():
        spans.append(F.min(time).alias(f"{prefix}_min"))
        spans.append(F.max(time).alias(f"{prefix}_max"))
    return df.groupBy(*keys).agg(*states, *spans)


def merge_states(
    states: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    prefixes: Sequence[str] = (),
) -> DataFrame:
    """Combine states of the same key."""
    return states.groupBy(*keys).agg(
        *[F.max(v).alias(v) for v in values],
        *[F.min(f"{p}_min").alias(f"{p}_min") for p in prefixes],
        *[F.max(f"{p}_max").alias(f"{p}_max") for p in prefixes],
    )


def finish_states(
    states: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    prefixes: Sequence[str] = (),
) -> DataFrame:
    """The plain values out of the states."""
    spans = [name for p in prefixes for name in (f"{p}_min", f"{p}_max")]
    return states.select(*keys, *[F.col(f"{v}.value").alias(v) for v in values], *spans)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    times: dict[str, str] | None = None,
) -> DataFrame:
    """Newest non-null value of each column per key, in the given total order."""
    prefixes = list((times or {}).values())
    states = latest_states(df, keys, values, order, times)
    return finish_states(states, keys, values, prefixes)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole newest row per key, NULLs included."""
    if not order:
        raise ValueError("an explicit order is needed to say what is latest")
    rest = [name for name in df.columns if name not in keys]
    row = F.struct(*[F.col(f"`{name}`") for name in rest])
    newest = df.groupBy(*keys).agg(
        F.max_by(row, F.struct(*[F.col(name) for name in order])).alias("_row")
    )
    return newest.select(*keys, "_row.*").select(*df.columns)
