"""Changelogs: the add and retract rows between two states of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changelog_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with ``is_add``: false retracts an old row, true adds a new one.

    Both sides hold one row per key. A row that is equal in both gives nothing.
    """
    columns = before.columns
    row = F.struct(*[F.col(f"`{name}`") for name in columns])
    old = before.select(*[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)], row.alias("_old"))
    new = after.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], row.alias("_new"))
    same_key = F.lit(True)
    for i in range(len(keys)):
        same_key = same_key & F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))
    both = old.join(new, same_key, "full")
    return changes_between(both)


def changes_between(both: DataFrame) -> DataFrame:
    """The add and retract rows of pairs ``_old`` and ``_new``, each of which may be NULL."""
    retract = F.struct(F.lit(False).alias("is_add"), F.col("_old").alias("row"))
    add = F.struct(F.lit(True).alias("is_add"), F.col("_new").alias("row"))
    changes = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), retract),
            F.when(F.col("_new").isNotNull(), add),
        )
    )
    return (
        both.filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(F.explode(changes).alias("_change"))
        .select("_change.is_add", "_change.row.*")
    )


def inserts_only(df: DataFrame) -> DataFrame:
    """An append-only table as a changelog: every row is an add."""
    return df.select(F.lit(True).alias("is_add"), *df.columns)


def apply_changelog(table: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after the changes: each row as often as it was added, net."""
    columns = table.columns
    step = F.when(F.col("is_add"), 1).otherwise(-1)
    moves = table.withColumn("_n", F.lit(1)).unionByName(
        changes.select(*columns, step.alias("_n"))
    )
    net = moves.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
    return net.withColumn("_copy", copies).select(*columns)
