"""Splitting one input into named branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.topics import parse_json


def route(df: DataFrame, edges: dict[str, Column | None]) -> dict[str, DataFrame]:
    """One DataFrame per branch; ``None`` takes every row.

    A row may go to several branches, and to none.
    """
    return {
        name: df if condition is None else df.filter(condition)
        for name, condition in edges.items()
    }


def route_labelled(df: DataFrame, edges: dict[str, Column | None]) -> DataFrame:
    """Each row once per branch that takes it, with the name in ``branch``.

    All branches come out of one read of the input; a row that none takes is gone.
    """
    taken = [
        F.lit(name) if condition is None else F.when(condition, F.lit(name))
        for name, condition in edges.items()
    ]
    return df.withColumn("branch", F.explode(F.array_compact(F.array(*taken))))


def parse_branch(
    branch: DataFrame,
    schema: StructType | str,
    view: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Typed rows of one branch, numbers quoted or not, optionally as a view."""
    rows = parse_json(branch, schema, keep=keep, lenient=True)
    if view is not None:
        rows.createOrReplaceTempView(view)
    return rows
