"""Change-event records ``{before, after, op, ts_ms}`` to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shape import once
from tidemark.functions.times import epoch_ms_to_timestamp

# Image field and the type of the flat column.
IMAGE_FIELDS = {
    "USER_ID": "string",
    "TASK_ID": "bigint",
    "COURSE_ID": "bigint",
    "TASK_TYPE": "int",
    "CRETERIA_TYPE": "int",
    "C_TIME": "bigint",
}


def flatten_changes(df: DataFrame, keep: tuple[str, ...] = ("proctime",)) -> DataFrame:
    """One flat row per event; each field on its own falls back to ``before``."""
    fields = [
        F.coalesce(F.col(f"after.{name}"), F.col(f"before.{name}")).alias(name.lower())
        for name in IMAGE_FIELDS
    ]
    return df.select(
        *fields, "op", epoch_ms_to_timestamp(F.col("ts_ms")).alias("ts_ms"), *keep
    )


def flatten_changes_by_presence(
    df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Flat rows from JSON text, choosing the image by whether the key is there.

    A key that ``after`` holds with JSON null stays NULL, where
    :func:`flatten_changes` would take ``before``. Quoted numbers are accepted.
    """
    message = once(
        F.from_json(
            F.col(value),
            "before MAP<STRING, STRING>, after MAP<STRING, STRING>, op STRING, ts_ms STRING",
        )
    )
    fields = [
        _present_field("_m.after", "_m.before", name).try_cast(kind).alias(name.lower())
        for name, kind in IMAGE_FIELDS.items()
    ]
    return df.select(*keep, message.alias("_m")).select(
        *fields,
        F.col("_m.op").alias("op"),
        F.col("_m.ts_ms").try_cast("bigint").alias("ts_ms"),
        *keep,
    )


def _present_field(after: str, before: str, name: str) -> Column:
    has_key = F.map_contains_key(F.col(after), name)
    return F.when(has_key, F.col(after)[name]).otherwise(F.col(before)[name])


def created_flag(op: Column) -> Column:
    """1 for a create. A NULL ``op`` is neither a create nor anything else."""
    return F.when(op == "c", 1).otherwise(0)


def other_flag(op: Column) -> Column:
    return F.when(op != "c", 1).otherwise(0)
