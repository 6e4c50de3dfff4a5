"""Topics of JSON messages, whatever carries them.

Transport and parsing are apart: a reader yields a ``value`` text column (and
``topic`` where there are several), the parsers turn it into typed rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.shape import once
from tidemark.schemas import parse_ddl

# Start positions a caller may name and Spark's words for them.
START_POSITIONS = {
    "earliest": "earliest",
    "earliest-offset": "earliest",
    "latest": "latest",
    "latest-offset": "latest",
    "group-offsets": None,
}


def topic_options(
    servers: str,
    topics: Sequence[str],
    start: str = "earliest",
    fallback: str = "latest",
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``group-offsets`` resumes from the query's checkpoint; ``fallback`` says where
    the first start begins, when there is no checkpoint yet.
    """
    if not topics:
        raise ValueError("name at least one topic")
    if start not in START_POSITIONS:
        raise ValueError(f"start must be one of {sorted(START_POSITIONS)}")
    if fallback not in ("earliest", "latest"):
        raise ValueError("fallback must be earliest or latest")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": START_POSITIONS[start] or fallback,
        **(extra or {}),
    }


def read_topics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of ``(topic, value)`` text. Needs Spark's Kafka package on the cluster."""
    messages = spark.readStream.format("kafka").options(**options).load()
    return messages.select("topic", F.col("value").cast("string").alias("value"))


def parse_json(
    df: DataFrame,
    schema: StructType | str,
    value: str = "value",
    keep: Sequence[str] = (),
    lenient: bool = False,
) -> DataFrame:
    """JSON text to the declared columns; fields it lacks are NULL.

    A field declared STRING whose payload is an object keeps the JSON text.
    ``lenient`` reads top-level fields as text first, so ``7`` and ``"7"`` both
    make a number.
    """
    declared = parse_ddl(schema) if isinstance(schema, str) else schema
    if not lenient:
        parsed = once(F.from_json(F.col(value), declared))
        return df.select(*keep, parsed.alias("_m")).select(*keep, "_m.*")
    as_text = StructType()
    for field in declared:
        as_text = as_text.add(field.name, StringType())
    columns = [
        F.col(f"_m.`{field.name}`").try_cast(field.dataType).alias(field.name)
        for field in declared
    ]
    parsed = once(F.from_json(F.col(value), as_text))
    return df.select(*keep, parsed.alias("_m")).select(*keep, *columns)


class ParsedMessages(NamedTuple):
    rows: DataFrame
    corrupt: DataFrame


def parse_json_checked(
    df: DataFrame,
    schema: StructType | str,
    value: str = "value",
    keep: Sequence[str] = (),
    mode: str = "split",
) -> ParsedMessages | DataFrame:
    """JSON text to the declared columns, with the broken messages set apart.

    A message is broken if it is no JSON object, or if a field holds another type than
    declared; a field it lacks is NULL. ``split`` returns good rows and, with ``keep``,
    the text of broken ones in ``_corrupt``: each message is in one of them.
    ``marked`` returns all rows, the text of broken ones in ``_corrupt`` and nothing in
    their other columns. ``failfast`` returns the rows alone and fails the job on a broken
    message.
    """
    if mode not in ("split", "marked", "failfast"):
        raise ValueError("mode must be split, marked or failfast")
    declared = parse_ddl(schema) if isinstance(schema, str) else schema
    marked = StructType([*declared.fields, StructField("_broken", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    # The text as well: a filter on it would otherwise have it made again for itself.
    texts = df.select(*keep, once(F.col(value)).alias("_text"))
    parsed = once(F.from_json(F.col("_text"), marked, options))
    rows = texts.select(*keep, "_text", parsed.alias("_m"))
    # An empty text gives no row at all, and no text for the broken one.
    blank = F.col("_text").isNull() | (F.trim("_text") == "")
    broken = blank | F.col("_m").isNull() | F.col("_m._broken").isNotNull()
    names = [F.col(f"_m.`{field.name}`").alias(field.name) for field in declared]
    if mode == "failfast":
        message = F.concat(F.lit("bad message: "), F.coalesce("_text", F.lit("NULL")))
        checked = F.when(broken, F.raise_error(message)).otherwise(F.col("_m"))
        return rows.select(*keep, checked.alias("_m")).select(*keep, *names)
    if mode == "marked":
        whole = F.when(~broken, F.col("_m")).alias("_m")
        marked_rows = rows.select(*keep, F.when(broken, F.coalesce("_text", F.lit(""))).alias("_corrupt"), whole)
        return marked_rows.select(*keep, "_corrupt", *names)
    return ParsedMessages(
        rows=rows.filter(~broken).select(*keep, *names),
        corrupt=rows.filter(broken).select(*keep, F.col("_text").alias("_corrupt")),
    )


def unwrap_envelope(
    df: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """``{"value": "<text>"}`` to the inner text; without a value the row is dropped."""
    inner = once(F.get_json_object(F.col(value), "$.value"))
    return df.select(*keep, inner.alias("value")).filter(F.col("value").isNotNull())


def unwrap_topic_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """``{"topic": t, "value": "<text>"}`` to the columns ``topic`` and ``value``."""
    parsed = once(F.from_json(F.col(value), "topic STRING, value STRING"))
    return (
        df.select(parsed.alias("_m"))
        .select("_m.topic", "_m.value")
        .filter(F.col("value").isNotNull())
    )


def as_message(topic: str, *fields: Column) -> list[Column]:
    """The columns ``topic`` and ``value`` of one outgoing JSON message."""
    return [F.lit(topic).alias("topic"), F.to_json(F.struct(*fields)).alias("value")]
