"""Keyed tables on plain parquet in hash buckets, fed by micro-batches.

A micro-batch rewrites the buckets of its keys into a new folder, and a small file then
says which folder holds which bucket. Until that file is there, readers and a repeated
micro-batch see the buckets as they were; afterwards a repeated one changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import finish_states, latest_rows, merge_states
from tidemark.schemas import parse_ddl
from tidemark.session import delete_path, list_names, read_text, session_conf, write_text

Combine = Callable[[DataFrame], DataFrame]
BUCKETS = 16
# Versions of the table that stay readable; the one before the last serves repeats.
KEPT_VERSIONS = 2


class BucketTable:
    """Rows in hash buckets of ``bucket_by`` and the function that combines them.

    ``combine`` must give the same result however its input was combined before, and
    keep the columns. It may use ``batch_id`` as the order of arrival. The number of
    buckets is part of the table: one bucket is the least that a batch rewrites, by as
    many tasks as the combined rows have partitions.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        combine: Combine,
        bucket_by: Sequence[str],
        buckets: int = BUCKETS,
    ):
        if buckets < 1 or not bucket_by:
            raise ValueError("a table needs at least one bucket and one column to bucket by")
        self.spark = spark
        self.path = path
        self.schema = parse_ddl(f"{schema}, batch_id BIGINT")
        self.combine = combine
        self.bucket_by = list(bucket_by)
        self.buckets = buckets

    def bucket(self) -> Column:
        types = {field.name: field.dataType for field in self.schema}
        keys = [F.col(name).cast(types[name]) for name in self.bucket_by]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` fall into."""
        found = rows.select(self.bucket().alias("bucket")).distinct().collect()
        return sorted(row["bucket"] for row in found)

    def put(self, rows: DataFrame, batch_id: int, kept: bool = False) -> None:
        """Combine the rows of one micro-batch into the buckets of their keys. The caller
        says whether it keeps the rows persisted itself."""
        if self.version(batch_id) is not None:
            return
        arrived = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        arrived = arrived.select(*self.schema.names)
        if not kept:
            arrived = arrived.persist()
        try:
            touched = self.buckets_of(arrived)
            old = self.rows(touched, before=batch_id)
            self.switch(self.combine(old.unionByName(arrived)), touched, batch_id)
        finally:
            if not kept:
                arrived.unpersist()

    def switch(self, rows: DataFrame, touched: Iterable[int], batch_id: int) -> None:
        """Make ``rows`` the content of the touched buckets, as of ``batch_id``."""
        if self.version(batch_id) is not None:
            return
        touched = list(touched)
        folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
        if touched:
            placed = rows.select(*self.schema.names, self.bucket().alias("bucket"))
            # Each task writes to all its buckets at a time: rows neither move nor are sorted.
            writers = {"spark.sql.maxConcurrentOutputFileWriters": str(self.buckets)}
            with session_conf(placed.sparkSession, writers):
                placed.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        held = self.version(before=batch_id) or {}
        held = {**held, **{str(number): folder for number in touched}}
        write_text(self.spark, f"{self.path}/versions/{batch_id:020d}", json.dumps(held))
        self._clean()

    def version(self, batch_id: int | None = None, before: int | None = None) -> dict | None:
        """Folder by bucket: of one batch, of the last one before one, or of the last."""
        names = sorted(list_names(self.spark, f"{self.path}/versions"))
        if batch_id is not None:
            names = [name for name in names if int(name) == batch_id]
        elif before is not None:
            names = [name for name in names if int(name) < before]
        if not names:
            return None
        return json.loads(read_text(self.spark, f"{self.path}/versions/{names[-1]}"))

    def rows(self, buckets: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """The rows, with ``batch_id``, of some buckets or all."""
        held = self.version(before=before) or {}
        wanted = sorted(held, key=int) if buckets is None else map(str, buckets)
        paths = [f"{self.path}/{held[name]}/bucket={name}" for name in wanted if name in held]
        # A bucket whose rows have all gone has no folder.
        folders: dict[str, set] = {}
        for path in paths:
            parent, name = path.rsplit("/", 1)
            if parent not in folders:
                folders[parent] = set(list_names(self.spark, parent))
        paths = [p for p in paths if p.rsplit("/", 1)[1] in folders[p.rsplit("/", 1)[0]]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The table as of the last written batch."""
        return self.rows().drop("batch_id")

    def _clean(self) -> None:
        """Drop old versions and the folders that no kept version names."""
        names = sorted(list_names(self.spark, f"{self.path}/versions"))
        kept, gone = names[-KEPT_VERSIONS:], names[:-KEPT_VERSIONS]
        if not gone:
            return
        held = set()
        for name in kept:
            held |= set(json.loads(read_text(self.spark, f"{self.path}/versions/{name}")).values())
        for name in gone:
            delete_path(self.spark, f"{self.path}/versions/{name}")
        for name in list_names(self.spark, self.path):
            if name.startswith("batch-") and name not in held:
                delete_path(self.spark, f"{self.path}/{name}")


def keyed_table(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> BucketTable:
    """One row per key: the newest by ``order``, then by batch.

    With no ``order`` a batch must hold one row per key, as an updating aggregate does.
    """

    def combine(rows: DataFrame) -> DataFrame:
        return latest_rows(rows, keys, [*order, "batch_id"])

    return BucketTable(spark, path, schema, combine, keys, buckets)


def state_table(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: Sequence[str],
    values: Sequence[str],
    prefixes: Sequence[str] = (),
    bucket_by: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> BucketTable:
    """Mergeable latest-value states per key, see ``operators.latest``."""

    def combine(rows: DataFrame) -> DataFrame:
        merged = merge_states(rows, keys, values, prefixes)
        return merged.withColumn("batch_id", F.lit(0).cast("bigint"))

    return BucketTable(spark, path, schema, combine, bucket_by or keys, buckets)


def read_latest(
    table: BucketTable, keys: Sequence[str], values: Sequence[str], prefixes: Sequence[str] = ()
) -> DataFrame:
    """Plain values out of a :func:`state_table`."""
    return finish_states(table.read(), keys, values, prefixes)
