"""Reshaping of rows: keys, nested rows, renames, alignment to a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import parse_ddl


def suffixed_key(key: Column, suffix: str = "") -> Column:
    """A key of any type as text with a suffix."""
    return F.concat(key.cast("string"), F.lit(suffix))


def nested_row(**fields: Column) -> Column:
    """A nested row from named columns."""
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def product(left: Column, right: Column) -> Column:
    """Product of two whole numbers, widened so that it does not overflow INT."""
    return left.cast("bigint") * right.cast("bigint")


def once(expression: Column) -> Column:
    """The value of a costly expression, computed once per row.

    Spark moves later filters, also those it infers from joins, in front of a plain
    projection and repeats the projected expression there. It does not move them in
    front of a generator such as ``stack``, here of one row.
    """
    return F.stack(F.lit(1), expression)


def project_nested(df: DataFrame, **paths: str) -> DataFrame:
    """Select dotted paths under new names: ``project_nested(df, jid="info.id")``."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(names)


def name_by_position(df: DataFrame, *names: str) -> DataFrame:
    return df.toDF(*names)


def align_to(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Order and cast the columns as the sink declares them, matching by name."""
    declared = parse_ddl(schema) if isinstance(schema, str) else schema
    missing = [field.name for field in declared if field.name not in df.columns]
    if missing:
        raise ValueError(f"the sink needs columns that are not there: {missing}")
    return df.select(
        *[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in declared]
    )
