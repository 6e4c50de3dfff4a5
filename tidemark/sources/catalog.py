"""Tables of the session catalog."""

from __future__ import annotations

from urllib.parse import urlparse

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def register_parquet(spark: SparkSession, name: str, path: str) -> None:
    """Declare a catalog table over existing files, without copying them.

    A table of that name stays as it is: over the same files it is this one, over others
    the name is taken.
    """
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
        return
    described = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`")
    rows = described.filter("col_name = 'Location'").select("data_type").collect()
    held = rows[0][0] if rows else None
    if held is None or urlparse(held).path != urlparse(path).path:
        raise ValueError(f"the catalog has another table {name}, at {held}")


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)


def save_bucketed(
    df: DataFrame, name: str, by: Sequence[str], buckets: int, path: str | None = None
) -> DataFrame:
    """Save ``df`` as the table ``name`` in buckets of ``by``, sorted by them, and read it.

    Tables with the same buckets join on ``by`` without a shuffle of either. Rows go to the
    task of their bucket first, so that a bucket is one file; a key with a large share of
    the rows makes its bucket that much larger. The catalog gets the size and the statistics
    of the columns ``by``, by which joins choose. ``path`` keeps the files outside the
    warehouse.
    """
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    if path is not None:
        writer = writer.option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    spark = df.sparkSession
    columns = ", ".join(f"`{column}`" for column in by)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {columns}")
    return spark.table(name)
