"""Compare a registered query with its SQL twin, or run all of them by hand."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return str(value) if value is not None else "~"


def rows_of(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(tuple(_plain(row[name]) for name in names) for row in df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple], dict[str, str]]:
    relation = con.sql(sql)
    names = sorted(relation.columns)
    places = [relation.columns.index(name) for name in names]
    rows = sorted(tuple(_plain(row[i]) for i in places) for row in relation.fetchall())
    types = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    return names, rows, types


# Spark's name of a type and the reader's.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(df: DataFrame, con, sql: str) -> str | None:
    """What differs, or None. Checks names, types and values."""
    names, expected, types = oracle_rows(con, sql)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} instead of {names}"
    for field, kind in df.dtypes:
        if TYPES.get(kind, kind) != types[field]:
            return f"{field} is {kind} instead of {types[field]}"
    actual = rows_of(df)
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for mine, other in zip(actual, expected):
        if mine != other:
            return f"{mine} instead of {other}"
    return None


def main(sf_dir: str, only: list[str]) -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    twins = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in twins:
                verdict = difference(df, con, twins[name]) or "ok"
            else:
                verdict = f"no twin, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - a report line per query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
