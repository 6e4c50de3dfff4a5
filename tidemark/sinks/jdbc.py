"""Upsert into a JDBC table: executors fill a staging table, one MERGE moves it over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_statement(
    target: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """Standard SQL that updates the rows of known keys and inserts the others."""
    missing = [key for key in keys if key not in columns]
    if missing or not keys:
        raise ValueError(f"the keys must be among the columns, missing: {missing}")
    rest = [name for name in columns if name not in keys]
    on = " AND ".join(f't."{key}" = s."{key}"' for key in keys)
    matched = ", ".join(f'"{name}" = s."{name}"' for name in rest)
    update = f" WHEN MATCHED THEN UPDATE SET {matched}" if rest else ""
    names = ", ".join(f'"{name}"' for name in columns)
    values = ", ".join(f's."{name}"' for name in columns)
    return (
        f"MERGE INTO {target} t USING {staging} s ON {on}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def duplicate_key_statement(
    target: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """The same for a MySQL-like database; ``target`` needs a unique index on the keys."""
    missing = [key for key in keys if key not in columns]
    if missing or not keys:
        raise ValueError(f"the keys must be among the columns, missing: {missing}")
    names = ", ".join(f"`{name}`" for name in columns)
    rest = [name for name in columns if name not in keys] or list(keys)
    update = ", ".join(f"`{name}` = VALUES(`{name}`)" for name in rest)
    return (
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"
        f" ON DUPLICATE KEY UPDATE {update}"
    )


# Dialects and the statement that moves staged rows over in each.
DIALECTS = {"standard": merge_statement, "mysql": duplicate_key_statement}


def upsert_jdbc(
    df: DataFrame,
    url: str,
    target: str,
    staging: str,
    keys: Sequence[str],
    flush_rows: int = 1000,
    properties: dict[str, str] | None = None,
    dialect: str = "standard",
) -> None:
    """Write ``df`` (one row per key) to ``staging`` in parallel, then merge it.

    Running it again with the same rows changes nothing, so a repeated micro-batch
    is harmless.
    """
    if flush_rows < 1:
        raise ValueError("flush_rows must be at least 1")
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {sorted(DIALECTS)}")
    options = {"batchsize": str(flush_rows), "truncate": "true", **(properties or {})}
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=staging, **options)
        .save()
    )
    _execute(df, url, DIALECTS[dialect](target, staging, df.columns, keys), properties or {})


def _execute(df: DataFrame, url: str, statement: str, properties: dict[str, str]) -> None:
    jvm = df.sparkSession._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        command = connection.createStatement()
        command.executeUpdate(statement)
        command.close()
    finally:
        connection.close()
