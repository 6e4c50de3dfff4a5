"""JDBC tables with a declared schema, read in parallel ranges of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    table: str,
    schema: str,
    fetch_size: int = 100,
    partition: tuple[str, int, int, int] | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; ``partition`` is (column, lower, upper, number of ranges).

    The bounds only place the cuts between ranges, no row outside them is lost.
    Credentials come in through ``properties`` and are never defaulted here.
    """
    if fetch_size < 1:
        raise ValueError("fetch_size must be at least 1")
    options = {
        "url": url,
        "dbtable": table,
        "customSchema": schema,
        "fetchsize": str(fetch_size),
        **(properties or {}),
    }
    if partition is not None:
        column, lower, upper, ranges = partition
        if lower >= upper or ranges < 1:
            raise ValueError("partition needs lower < upper and at least one range")
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(ranges),
        )
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
