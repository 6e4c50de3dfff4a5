"""Lookups in a table at the time the rows arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.latest import latest_by_key
from tidemark.sources.ranges import RangedCells, asked_cells
from tidemark.sources.widecolumn import read_rows, row_layout


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    row_key: str,
    table_key: str,
    how: str = "left",
    fields: dict[str, str] | None = None,
) -> DataFrame:
    """Rows with fields of the table row of the same key.

    ``fields`` maps output names to (dotted) table columns; by default every table
    column comes along. Keys that repeat in the table fan out, a NULL key matches
    nothing. Spark broadcasts the table only where its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and splits heavy keys of the sorted
    join otherwise.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    paths = fields or {name: f"`{name}`" for name in table.columns}
    clash = sorted(set(paths) & set(rows.columns))
    if clash:
        raise ValueError(f"columns on both sides, name them in fields: {clash}")
    looked_up = table.select(
        F.col(table_key).alias("_key"),
        *[F.col(path).alias(name) for name, path in paths.items()],
    )
    return rows.join(looked_up, F.col(row_key) == F.col("_key"), how).drop("_key")


def lookup_by_row_key(
    rows: DataFrame,
    table: DataFrame,
    row_key: str,
    table_keys: Sequence[str],
    fields: dict[str, str],
    how: str = "inner",
) -> DataFrame:
    """Lookup in a wide-column table, which answers to its row key only."""
    if len(table_keys) != 1:
        raise ValueError("a wide-column table is looked up by one key")
    declared_key, _ = row_layout(table.schema)
    if table_keys[0] != declared_key:
        raise ValueError(f"the lookup key must be the row key {declared_key}")
    return lookup_join(rows, table, row_key, declared_key, how, fields)


def lookup_in_cells(
    rows: DataFrame,
    cells: DataFrame,
    schema: StructType | str,
    row_key: str,
    fields: dict[str, str],
    families: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Lookup in a table kept as cells, by the distinct keys of the rows.

    Only the cells of keys that are asked for are put together to rows.
    """
    declared_key, _ = row_layout(schema)
    asked = rows.select(F.col(row_key).alias("rowkey")).distinct()
    asked_cells = cells.join(asked, "rowkey", "left_semi")
    table = read_rows(asked_cells, schema, families)
    return lookup_by_row_key(rows, table, row_key, [declared_key], fields, how)


def lookup_in_ranges(
    rows: DataFrame,
    table: RangedCells,
    schema: StructType | str,
    row_key: str,
    fields: dict[str, str],
    families: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """:func:`lookup_in_cells` in a table kept in ranges of the row key, of which only
    those are read that hold a key of the rows."""
    declared_key, _ = row_layout(schema)
    found = read_rows(asked_cells(rows, table, row_key), schema, families)
    return lookup_by_row_key(rows, found, row_key, [declared_key], fields, how)


def asked_rows(rows: DataFrame, table: DataFrame, row_key: str, table_key: str) -> DataFrame:
    """The rows of the table that the distinct keys of ``rows`` ask for."""
    asked = rows.select(F.col(row_key).alias("_asked")).distinct()
    return table.join(asked, F.col(table_key) == F.col("_asked"), "left_semi")


def latest_enriched(
    rows: DataFrame,
    table: DataFrame,
    row_key: str,
    table_key: str,
    fields: dict[str, str],
    own: Sequence[str],
    order: Sequence[str],
    time: str,
) -> DataFrame:
    """Lookup, then per key the latest values and the first and last arrival.

    Output: the key, ``own`` and ``fields``, ``c_time`` and ``m_time``.
    """
    enriched = lookup_join(rows, table, row_key, table_key, "left", fields)
    latest = latest_by_key(
        enriched, [row_key], [*own, *fields], order, times={time: "t"}
    )
    return latest.withColumnsRenamed({"t_min": "c_time", "t_max": "m_time"})


def performance_by_ref(
    performance: DataFrame, users: DataFrame, ref: str, fields: dict[str, str]
) -> DataFrame:
    """Task performance joined to the user table, latest row per user reference.

    ``fields`` maps the output columns to table columns; ``ref`` is the table key.
    """
    joined = lookup_join(
        performance.withColumnRenamed("user_id", "_user"),
        users,
        "_user",
        ref,
        "inner",
        {"user_ref": ref, **fields},
    )
    totals = [
        "task_count",
        "course_count",
        "sum_task_type",
        "sum_creteria_type",
        "sum_time",
        "sum_create",
        "sum_other",
    ]
    latest = latest_by_key(
        joined,
        ["user_ref"],
        [*fields, *totals],
        # The fields make the order total, so that all columns come from one row.
        order=["max_proctime", *fields],
        times={"max_proctime": "t"},
    )
    return latest.drop("t_min").withColumnRenamed("t_max", "m_time")
