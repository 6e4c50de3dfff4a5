"""Wide-column cells laid out in ranges of their row key, and lookups that read few of them.

The cells lie in a folder for each range; a small table says where the ranges begin and
end. A lookup finds the ranges of its keys there, and Spark leaves the other folders unread
when the query runs (dynamic partition pruning).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ranges of a table: what a lookup broadcasts is at most that many rows.
MOST_RANGES = 4096


class RangedCells(NamedTuple):
    cells: DataFrame  # (rowkey, family, qualifier, value, version, range)
    ranges: DataFrame  # (range, low, high), a row each


def write_ranges(cells: DataFrame, path: str, ranges: int) -> None:
    """Write ``cells`` in about ``ranges`` ranges of the row key, alike in size.

    All cells of a row are in one range. Cells without a row key are left out: no lookup
    finds them. A row key with a large share of the cells makes its range that much larger.
    """
    if not 1 <= ranges <= MOST_RANGES:
        raise ValueError(f"ranges must be from 1 to {MOST_RANGES}")
    known = cells.filter(F.col("rowkey").isNotNull())
    placed = known.repartitionByRange(ranges, "rowkey").withColumn("range", F.spark_partition_id())
    placed.sortWithinPartitions("rowkey").write.partitionBy("range").parquet(f"{path}/cells")
    written = cells.sparkSession.read.schema(placed.schema).parquet(f"{path}/cells")
    edges = written.groupBy("range").agg(F.min("rowkey").alias("low"), F.max("rowkey").alias("high"))
    edges.coalesce(1).write.parquet(f"{path}/ranges")


def read_ranges(spark: SparkSession, path: str) -> RangedCells:
    return RangedCells(spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/ranges"))


def asked_cells(rows: DataFrame, table: RangedCells, row_key: str) -> DataFrame:
    """The cells of the keys of ``rows``, out of the ranges that hold such keys."""
    asked = rows.select(F.col(row_key).alias("rowkey")).filter(F.col("rowkey").isNotNull()).distinct()
    inside = (F.col("rowkey") >= F.col("low")) & (F.col("rowkey") <= F.col("high"))
    # Spark prunes by a side that has a filter of its own, which ranges satisfy by nature.
    touched = asked.join(F.broadcast(table.ranges), inside).select("range").filter("range >= 0").distinct()
    cells = table.cells.join(F.broadcast(touched), "range", "left_semi")
    return cells.drop("range").join(asked, "rowkey", "left_semi")
