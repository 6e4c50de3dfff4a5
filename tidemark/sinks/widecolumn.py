"""Nested rows to wide-column cells, and changes to the cells of a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.widecolumn import row_layout

# The smallest buffer a wide-column writer may be given.
MIN_FLUSH_BYTES = 1_048_576
MIN_FLUSH_ROWS = 1
MIN_FLUSH_MILLIS = 1

CELL_KEY = ["rowkey", "family", "qualifier"]


@dataclass(frozen=True)
class WriteOptions:
    """What a wide-column writer needs to know; checked when it is made."""

    table: str
    quorum: str
    node_parent: str | None = None
    flush_bytes: int | None = None
    flush_rows: int | None = None
    flush_millis: int | None = None

    def __post_init__(self) -> None:
        if not self.table or not self.quorum:
            raise ValueError("table and quorum are required")
        if self.node_parent is not None and not self.node_parent:
            raise ValueError("node_parent must not be empty")
        limits = [
            ("flush_bytes", self.flush_bytes, MIN_FLUSH_BYTES),
            ("flush_rows", self.flush_rows, MIN_FLUSH_ROWS),
            ("flush_millis", self.flush_millis, MIN_FLUSH_MILLIS),
        ]
        for name, value, least in limits:
            if value is not None and value < least:
                raise ValueError(f"{name} must be at least {least}")


def to_cells(rows: DataFrame, version: Column, deletes: bool = False) -> DataFrame:
    """One cell per row and qualifier, the value as text.

    NULL values stay out; with ``deletes`` they are cells without a value.
    """
    key, families = row_layout(rows.schema)
    cells = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(field.name).alias("qualifier"),
            F.col(f"`{family}`.`{field.name}`").cast("string").alias("value"),
        )
        for family, declared in families.items()
        for field in declared
    ]
    exploded = rows.select(
        F.col(key).cast("string").alias("rowkey"),
        version.cast("bigint").alias("version"),
        F.explode(F.array(*cells)).alias("_cell"),
    )
    if not deletes:
        exploded = exploded.filter(F.col("_cell.value").isNotNull())
    return exploded.select(
        "rowkey", "_cell.family", "_cell.qualifier", "_cell.value", "version"
    )


def apply_to_cells(cells: DataFrame, changes: DataFrame, version: Column) -> DataFrame:
    """Cells after add and retract rows: an add sets its cells, and clears those whose
    value is NULL in it; a retract drops the row.

    Where a row key is retracted and added again in one set of changes, the add holds.
    """
    key, _ = row_layout(_row_schema(changes))
    adds = changes.filter("is_add").drop("is_add")
    kept = cells.join(
        changes.filter(~F.col("is_add")).select(F.col(key).cast("string").alias("rowkey")),
        "rowkey",
        "left_anti",
    )
    newest = F.max_by(F.struct("value", "version"), "version").alias("_cell")
    return (
        kept.unionByName(to_cells(adds, version, deletes=True))
        .groupBy(*CELL_KEY)
        .agg(newest)
        .filter(F.col("_cell.value").isNotNull())
        .select(*CELL_KEY, "_cell.value", "_cell.version")
    )


def _row_schema(changes: DataFrame) -> StructType:
    return StructType([f for f in changes.schema if f.name != "is_add"])
