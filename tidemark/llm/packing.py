"""Conflict-constrained best-fit packing (operator 6)."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_table

# Rows that one task packs at a time. Bins hold a handful of documents, so the bins left
# open at the edge of a shard do not count.
SHARD_ROWS = 4096


class Bins:
    """Bins by what they have left, each with the sources and clusters it holds."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.left: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.by_left: dict[int, list[int]] = {}
        self.occupied = 0  # bit r: some bin has r left

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin that is tightest among those without a conflict, and the start in it.

        ``source`` and ``cluster`` are bitmaps, 0 where nothing conflicts. The search
        goes through the occupied residuals from ``size`` upwards; a new bin is opened
        when it ends without a find.
        """
        ahead = self.occupied >> size
        left = size
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            left += step
            for at, bin_id in enumerate(self.by_left[left]):
                if not (self.sources[bin_id] & source or self.clusters[bin_id] & cluster):
                    self._take(left, at)
                    return self._fill(bin_id, left, size, source, cluster)
            ahead >>= step + 1
            left += 1
        self.left.append(self.capacity)
        self.sources.append(0)
        self.clusters.append(0)
        return self._fill(len(self.left) - 1, self.capacity, size, source, cluster)

    def _take(self, left: int, at: int) -> None:
        same = self.by_left[left]
        del same[at]
        if not same:
            self.occupied &= ~(1 << left)

    def _fill(self, bin_id: int, left: int, size: int, source: int, cluster: int):
        self.sources[bin_id] |= source
        self.clusters[bin_id] |= cluster
        self.left[bin_id] = rest = left - size
        self.by_left.setdefault(rest, []).append(bin_id)
        self.occupied |= 1 << rest
        return bin_id, self.capacity - left


def _bitmaps(values: list) -> list[int]:
    """A bit for each value; 0 for null and for values met once."""
    many = [v for v, n in Counter(values).items() if n > 1 and v is not None]
    bits = {value: 1 << place for place, value in enumerate(many)}
    return [bits.get(value, 0) for value in values]


def pack_shard(
    sizes: list[int], sources: list, clusters: list, capacity: int
) -> tuple[list[int], list[int], list[int]]:
    """Best-fit in the given order: for each item its bin, its start there, and what
    the bin has left in the end."""
    bins = Bins(capacity)
    placed = [
        bins.place(*item) for item in zip(sizes, _bitmaps(sources), _bitmaps(clusters))
    ]
    chosen = [bin_id for bin_id, _ in placed]
    return chosen, [start for _, start in placed], [bins.left[bin_id] for bin_id in chosen]


def pack(
    documents: DataFrame,
    size: Column,
    cluster: Column,
    capacity: int = 2048,
    separate_sources: bool = True,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Place every document in bins of ``capacity``, tightest compatible bin first.

    ``size`` and ``cluster`` are columns of ``documents``. No bin holds two rows of one
    duplicate cluster or, with ``separate_sources``, of one source; nulls never
    conflict. A document above the capacity is cut into pieces, of which all but the
    last fill a bin. Returns ``(id, piece, size, shard, bin, start, bin_left)``, a row
    per piece; a bin is named by shard and bin, ``start`` is the place inside it and
    ``bin_left`` what stays free. In a shard larger pieces go first.

    Sizes that are null or negative count as 0; a document of size 0 still gets a place.
    Ids may be null or repeat. Other columns are ignored. Shards are dealt by a hash of
    the row's number in a written table, so copies of one row spread over all of them.
    """
    items = documents.select(
        documents[id_col].alias("_id"),
        F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).alias("_whole"),
        (documents[source_col] if separate_sources else F.lit(None)).cast("string").alias("_source"),
        cluster.cast("string").alias("_cluster"),
    )
    items = shared_table(items.withColumn("_row", F.monotonically_increasing_id()), "packing")
    last = F.greatest(F.ceil(F.col("_whole") / F.lit(capacity)) - 1, F.lit(0)).cast("bigint")
    items = items.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    part = F.least(F.lit(capacity).cast("bigint"), F.col("_whole") - F.col("_piece") * capacity)
    items = items.withColumn("_size", part)
    shards = max(1, -(-items.agg(F.count("*")).first()[0] // shard_rows))
    shard = F.pmod(F.xxhash64("_row", "_piece"), F.lit(shards)).cast("bigint")
    items = items.select(
        "_id", "_row", "_piece", "_size", "_source", "_cluster", shard.alias("shard")
    )
    id_type = items.schema["_id"].dataType.simpleString()
    schema = (
        f"`{id_col}` {id_type}, piece bigint, size bigint, shard bigint, bin bigint, "
        "start bigint, bin_left bigint"
    )

    def run(own: pa.Table) -> pa.Table:
        keys = [("_size", "descending"), ("_row", "ascending"), ("_piece", "ascending")]
        own = own.sort_by(keys)
        lists = [own[name].to_pylist() for name in ("_size", "_source", "_cluster")]
        chosen, starts, left = pack_shard(*lists, capacity)
        return pa.table(
            {
                id_col: own["_id"],
                "piece": own["_piece"],
                "size": own["_size"],
                "shard": own["shard"],
                "bin": chosen,
                "start": starts,
                "bin_left": left,
            }
        )

    return items.groupBy("shard").applyInArrow(run, schema)
