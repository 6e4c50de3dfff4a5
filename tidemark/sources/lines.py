"""Delimited text lines to typed rows, with the bad lines set apart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.shape import once
from tidemark.functions.times import local_text_to_timestamp
from tidemark.schemas import parse_ddl


class ParsedLines(NamedTuple):
    rows: DataFrame
    corrupt: DataFrame


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text lines as a ``value`` column; splittable, and usable as a stream."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path)


def _typed(declared: StructType, value: str, separator: str, zones: dict[str, str]):
    """The typed fields by position in one nested row."""
    if len(separator) != 1:
        raise ValueError("the separator must be one character")
    # Escaped where a regular expression would read it as an operator.
    pattern = separator if separator.isalnum() or separator in ",;: \t" else f"\\{separator}"
    parts = F.split(F.col(value), pattern)
    fields = []
    for position, field in enumerate(declared, start=1):
        text = F.try_element_at(parts, F.lit(position))
        zone = zones.get(field.name)
        typed = local_text_to_timestamp(text, zone) if zone else text.try_cast(field.dataType)
        fields.append(typed.alias(field.name))
    return once(F.struct(*fields))


def parse_lines(
    df: DataFrame,
    schema: StructType | str,
    value: str = "value",
    separator: str = ",",
    keep: tuple[str, ...] = (),
    mode: str = "split",
    zones: dict[str, str] | None = None,
) -> ParsedLines | DataFrame:
    """Lines to typed rows by position.

    ``split`` returns good rows and corrupt lines as two DataFrames.
    ``failfast`` returns the rows alone and fails the job on a bad line.
    Extra fields at the end of a line are ignored. ``zones`` names time fields that
    hold wall-clock text of a zone; a time that cannot be read makes a bad line.
    """
    declared = parse_ddl(schema) if isinstance(schema, str) else schema
    if mode not in ("split", "failfast"):
        raise ValueError("mode must be split or failfast")
    parsed = df.select(
        *keep, F.col(value).alias("_line"), _typed(declared, value, separator, zones or {}).alias("_m")
    )
    broken = F.lit(False)
    for field in declared:
        broken = broken | F.col(f"_m.`{field.name}`").isNull()
    if mode == "failfast":
        message = F.concat(F.lit("bad line: "), F.coalesce("_line", F.lit("NULL")))
        checked = F.when(broken, F.raise_error(message)).otherwise(F.col("_m"))
        return parsed.select(*keep, checked.alias("_m")).select(*keep, "_m.*")
    return ParsedLines(
        rows=parsed.filter(~broken).select(*keep, "_m.*"),
        corrupt=parsed.filter(broken).select(*keep, F.col("_line").alias("_corrupt")),
    )
