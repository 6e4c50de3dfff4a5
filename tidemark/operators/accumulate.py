"""User-defined aggregates as column expressions: create, merge, finish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Accumulator:
    """``create`` aggregates input rows, ``merge`` aggregates such partial results,
    ``finish`` computes the outputs; all by column name."""

    create: dict[str, Column]
    merge: dict[str, Column]
    finish: dict[str, Column]

    def partial(self, df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        return df.groupBy(*keys).agg(*_named(self.create))

    def merged(self, partials: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
        return partials.groupBy(*keys).agg(*_named(self.merge))

    def finished(self, partials: DataFrame, keys: Sequence[str]) -> DataFrame:
        return partials.select(*keys, *_named(self.finish))

    def aggregate(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self.finished(self.partial(df, keys), keys)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def average(value: str, output: str = "average") -> Accumulator:
    """Sum and count of whole numbers, finished to their ratio."""
    return Accumulator(
        create={"_sum": F.sum(F.col(value).cast("bigint")), "_count": F.count(value)},
        merge={"_sum": F.sum("_sum"), "_count": F.sum("_count")},
        finish={output: F.col("_sum").cast("double") / F.col("_count")},
    )
