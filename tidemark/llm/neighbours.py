"""Nearest neighbours by multiprobe p-stable hashing (operator 4).

A hash function cuts the line of a random (Gaussian) projection into slots; a table joins
some of them into buckets. The index holds every vector once a table, by bucket. A query
lists the perturbed buckets of each table in the order of their estimated success, the
distance of its projections to their slots, and is joined with those of them that exist;
buckets that are too full for a task are cut into parts. What the tables give together is
ranked by exact products.

The first buckets, where near vectors are likeliest, are visited before the others: from
then on only candidates that reach the k-th best of a query's so far leave a task. A query
stops at a limit learned on a bounded sample. The k-th candidate so found says how
far its neighbours lie: if that asks for more, it goes on in a second round to the limit
learned for that distance. Queries that have fewer than k candidates then, or lie farther
off than any of the sample, are held against all rows, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, shared_table

SAMPLE = 2000  # vectors the probing limit is learned on
TABLES = 2
WIDTH = 1.6  # of a slot, in standard deviations of the projections
MOST_FUNCTIONS = 24
RECALL = 0.96  # of the neighbours in the sample that the limit must reach
BUCKET_ROWS = 512  # vectors of a bucket that the number of functions aims at
PART_ROWS = 4096  # of a bucket that one task holds at a time
FIRST = 8  # buckets of a table that are visited before the others
CHUNK = 512  # queries multiplied at a time
POOL = 20  # queries of the sample a limit by distance is learned on
EDGE_ROWS = 100_000  # products added up at a time
HELD_ROWS = 500_000  # candidates that a task gathers before it keeps the k best of each


class Hashing(NamedTuple):
    projections: list[np.ndarray]  # a table each, (dimension + 1, functions)
    offsets: list[np.ndarray]
    width: float
    limit: float
    norm: float
    reach: np.ndarray  # ascending squared distances of the k-th neighbour
    limits: np.ndarray  # up to each of these

    def limit_at(self, square: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.reach, square + 1e-9, side="right")
        return np.maximum(self.limit, np.append(self.limits, np.inf)[at])


def augmented(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Vectors whose Euclidean order is that of the inner products: candidates get a
    coordinate that makes all of them as long as the longest, queries get 0."""
    if query:
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.hstack([vectors / np.where(lengths > 0, lengths, 1), np.zeros((len(vectors), 1))])
    rest = np.sqrt(np.maximum(0.0, 1 - (vectors / norm * (vectors / norm)).sum(axis=1)))
    return np.hstack([vectors / norm, rest[:, None]])


def places(hashing: Hashing, vectors: np.ndarray, table: int) -> np.ndarray:
    """Where vectors lie on the functions' lines, in slots."""
    return (vectors @ hashing.projections[table] + hashing.offsets[table]) / hashing.width


def bucket_keys(slots: np.ndarray, table: int) -> np.ndarray:
    """The names of buckets, rows of slots."""
    keys = np.full(len(slots), table, dtype=np.uint64)
    for column in slots.T:
        keys = mix64(keys + column.astype(np.int64).view(np.uint64))
    return keys.view(np.int64)


def probes(at: np.ndarray, above: float, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one query whose score lies in ``(above, limit]``, and the scores,
    ascending. A score is the sum of the squared gaps between the query and the slots; the
    smaller, the likelier is a near vector in the bucket. The query's own bucket has 0."""
    scores, slots = np.zeros(1), np.zeros((1, 0), dtype=np.int64)
    own = np.floor(at).astype(np.int64)
    far = int(np.ceil(np.sqrt(limit)))
    steps = np.arange(-far, far + 1)
    for place, slot in zip(at, own):
        gaps = np.square(np.maximum(np.maximum(slot + steps - place, place - slot - steps - 1), 0.0))
        both = scores[:, None] + gaps[None, :]
        row, step = np.nonzero(both <= limit)
        scores = both[row, step]
        slots = np.hstack([slots[row], (slot + steps[step])[:, None]])
    order = np.argsort(scores, kind="stable")
    order = order[scores[order] > above]
    return slots[order], scores[order]


def _functions(slots: np.ndarray, total: int) -> int:
    """How many functions make buckets of about ``BUCKET_ROWS`` of ``total`` vectors, fewer
    for a small table, by the entropy of their slots in the sample."""
    aim = min(BUCKET_ROWS, max(8, total // 64))
    wanted, bits = np.log2(max(total / aim, 2)), 0.0
    for count, column in enumerate(slots.T, 1):
        share = np.unique(column, return_counts=True)[1] / len(column)
        bits -= float((share * np.log2(share)).sum())
        if bits >= wanted:
            return count
    return slots.shape[1]


def fit(sample: np.ndarray, total: int, norm: float, k: int, seed: int = 5) -> Hashing:
    """Draw the functions and learn how far to probe.

    ``total`` vectors hold ``k`` neighbours of a query, so the sample holds its share of
    them, one at least; the limit is the distance within which ``RECALL`` of these
    are met in the nearer of the tables. As a few scattered vectors do not show in it
    beside many copies, limits are also learned on pools of queries by the distance of
    their farthest neighbour.
    """
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1] + 1
    drawn = rng.normal(size=(TABLES, dimension, MOST_FUNCTIONS))
    own = augmented(sample, norm, query=False)
    width = WIDTH * float(np.std(own @ drawn[0])) or 1.0
    shifts = rng.uniform(0, width, size=(TABLES, MOST_FUNCTIONS))
    counts = [_functions(np.floor((own @ p + s) / width), total) for p, s in zip(drawn, shifts)]
    hashing = Hashing(
        [p[:, :n] for p, n in zip(drawn, counts)], [s[:n] for s, n in zip(shifts, counts)],
        width, 0.0, norm, np.zeros(0), np.zeros(0),
    )
    if len(sample) < 2:
        return hashing
    queries = np.arange(0, len(sample), max(1, len(sample) // 500))
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    share = min(len(sample) - 1, max(1, round(k * len(sample) / max(total, 1))))
    near = np.argsort(-scores, axis=1)[:, :share]
    asked = augmented(sample[queries], norm, query=True)
    least = np.full(near.shape, np.inf)
    for table in range(TABLES):
        at = places(hashing, asked, table)[:, None, :]
        slots = np.floor(places(hashing, own, table))[near]
        gaps = np.maximum(np.maximum(slots - at, at - slots - 1), 0.0)
        least = np.minimum(least, np.square(gaps).sum(axis=2))
    last = scores[np.arange(len(queries)), near[:, -1]]
    square = squares(last, sample[queries], norm)
    pools = np.array_split(np.argsort(square, kind="stable"), max(1, len(queries) // POOL))
    limits = np.maximum.accumulate([np.quantile(least[pool], RECALL) for pool in pools])
    reach = np.array([square[pool].max() for pool in pools])
    return hashing._replace(limit=float(np.quantile(least, RECALL)), reach=reach, limits=limits)


def squares(scores: np.ndarray, queries: np.ndarray, norm: float) -> np.ndarray:
    """Squared distances, as of ``augmented`` vectors, of candidates with these products."""
    lengths = np.linalg.norm(queries, axis=1)
    return 2 - 2 * scores / (norm * np.where(lengths > 0, lengths, 1))


def kth_best(scores: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row. The columns from each of ``starts`` on are copies
    of one id: one candidate, with the best of their scores."""
    if len(starts) < scores.shape[1]:
        scores = np.maximum.reduceat(scores, starts, axis=1)
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def k_best(found: Found, k: int) -> Found:
    """The k best candidates of each query, each once with its best score."""
    query, ids, scores = found
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    new = np.ones(len(query), dtype=bool)
    new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, ids, scores = query[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[top], ids[top], scores[top]


def visit(
    points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, k: int
) -> Found:
    """The k best points of a bucket for each query that reach the query's bound, as
    (query id, id, score) columns."""
    order = np.argsort(ids, kind="stable")
    points, ids = points[order], ids[order]
    starts = np.unique(ids, return_index=True)[1]
    found: list[Found] = []
    for start in range(0, len(queries), CHUNK):
        part = slice(start, start + CHUNK)
        scores = queries[part] @ points.T
        scores[query_ids[part][:, None] == ids[None, :]] = -np.inf
        least = np.maximum(kth_best(scores, starts, k), bounds[part])
        # Products of equal vectors may differ in the last place here; those at the
        # edge are all kept and ranked by products added up in one order.
        slack = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
        row, column = np.nonzero((scores >= (least - slack)[:, None]) & np.isfinite(scores))
        exact = np.zeros(len(row))
        for low in range(0, len(row), EDGE_ROWS):
            own = slice(low, low + EDGE_ROWS)
            exact[own] = (queries[part][row[own]] * points[column[own]]).sum(axis=1)
        found.append(k_best((query_ids[part][row], ids[column], exact), k))
    return tuple(np.concatenate(columns) for columns in zip(*found))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, dimension)


def met_in_buckets(points: DataFrame, asked: DataFrame, dimension: int, k: int) -> DataFrame:
    """``(query_id, vec_id, score, visited)`` for rows ``(_table, _key, _part, _id, _v)`` of
    both sides that meet; queries also have ``_least``, the score that candidates must
    reach. Rows with a null ``vec_id`` count the products of a query.

    A task holds the points of one part of a bucket and one batch of its queries.
    """
    by = ["_table", "_key", "_part"]
    points = points.withColumns({"_role": F.lit(0), "_least": F.lit(None).cast("double")})
    rows = points.unionByName(asked.withColumn("_role", F.lit(1)))
    rows = rows.select(*by, "_role", "_id", "_v", "_least").repartition(*by).sortWithinPartitions(*by, "_role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, bucket, found, products, size = None, [], None, [], {}, 0
        for batch in batches:
            places = np.stack([batch[c].to_numpy() for c in (*by, "_role")])
            cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                part, key = batch.slice(start, stop - start), tuple(places[:3, start].tolist())
                own = part["_id"].to_numpy(), _matrix(part["_v"], dimension)
                if places[3, start] == 0:
                    if key != at:
                        at, held, bucket = key, [], None
                    held.append(own)
                elif key == at:
                    if bucket is None:
                        bucket = [np.concatenate(columns) for columns in zip(*held)]
                    bounds = part["_least"].to_numpy()
                    found.append(visit(bucket[1], bucket[0], own[1], own[0], bounds, k))
                    size += len(found[-1][0])
                    for query in own[0].tolist():
                        products[query] = products.get(query, 0) + len(bucket[0])
                if size >= HELD_ROWS:
                    yield _found(found, products, k)
                    found, products, size = [], {}, 0
        if found:
            yield _found(found, products, k)

    return rows.mapInArrow(run, "query_id bigint, vec_id bigint, score double, visited bigint")


def _found(found: list[Found], products: dict[int, int], k: int) -> pa.RecordBatch:
    query, ids, scores = k_best(tuple(np.concatenate(columns) for columns in zip(*found)), k)
    counted, none = len(products), len(query)
    return pa.RecordBatch.from_pydict(
        {
            "query_id": pa.array(np.concatenate([query, np.array(list(products), dtype=np.int64)])),
            "vec_id": pa.array([*ids.tolist(), *[None] * counted], pa.int64()),
            "score": pa.array([*scores.tolist(), *[None] * counted], pa.float64()),
            "visited": pa.array([*[None] * none, *products.values()], pa.int64()),
        }
    )


def indexed(points: DataFrame, hashing: Hashing, dimension: int) -> DataFrame:
    """``(_table, _key, _id, _v)``: every vector in its bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = augmented(_matrix(batch["_v"], dimension), hashing.norm, query=False)
            for table in range(TABLES):
                keys = bucket_keys(np.floor(places(hashing, vectors, table)), table)
                columns = [pa.array(np.full(len(keys), table), pa.int32()), pa.array(keys), batch["_id"], batch["_v"]]
                yield pa.RecordBatch.from_arrays(columns, ["_table", "_key", "_id", "_v"])

    return points.mapInArrow(run, "_table int, _key bigint, _id bigint, _v array<double>")


def probing(asked: DataFrame, hashing: Hashing, dimension: int, places_: slice = slice(None)) -> DataFrame:
    """``(_table, _key, _id, _v, _least)``: each query with its buckets between ``_above``
    and ``_limit``, those at ``places_`` in the order of their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = augmented(_matrix(batch["_v"], dimension), hashing.norm, query=True)
            bounds = list(zip(batch["_above"].to_pylist(), batch["_limit"].to_pylist()))
            for table in range(TABLES):
                at = places(hashing, vectors, table)
                for row, (above, limit) in enumerate(bounds):
                    slots = probes(at[row], above, limit)[0][places_]
                    keys = np.unique(bucket_keys(slots, table))
                    own = pa.array(np.full(len(keys), row), pa.int64())
                    columns = [pa.array(np.full(len(keys), table), pa.int32()), pa.array(keys)]
                    columns += [batch[c].take(own) for c in ("_id", "_v", "_least")]
                    yield pa.RecordBatch.from_arrays(columns, ["_table", "_key", "_id", "_v", "_least"])

    return asked.mapInArrow(run, "_table int, _key bigint, _id bigint, _v array<double>, _least double")


def with_least(asked: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """``(_id, _v, _least)``: the k-th best score of each query so far, or minus infinity."""
    last = best.groupBy("query_id").agg(F.count("*").alias("_many"), F.min("score").alias("_last"))
    least = F.when(F.col("_many") >= k, F.col("_last")).otherwise(F.lit(float("-inf"))).alias("_least")
    return asked.join(last, asked["_id"] == last["query_id"], "left").select("_id", "_v", least)


def going_on(asked: DataFrame, hashing: Hashing, dimension: int) -> DataFrame:
    """The queries ``(_id, _v, _least)`` that need more buckets, with ``_above`` and the
    ``_limit`` to go to, infinite where only all rows will do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = batch["_least"].to_numpy()
            square = squares(least, _matrix(batch["_v"], dimension), hashing.norm)
            limit = np.where(np.isinf(least), np.inf, hashing.limit_at(square))
            columns = [*batch.columns, pa.array(np.full(len(limit), hashing.limit)), pa.array(limit)]
            rows = pa.RecordBatch.from_arrays(columns, ["_id", "_v", "_least", "_above", "_limit"])
            yield rows.filter(pa.array(limit > hashing.limit))

    fields = "_id bigint, _v array<double>, _least double, _above double, _limit double"
    return asked.mapInArrow(run, fields)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query with their ``rank``."""
    found = found.filter("vec_id IS NOT NULL").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score, visited)``: the k candidates of largest inner
    product; ``visited`` counts the products that the query took.

    ``queries`` are rows of the form of ``vectors``. A query is never its own
    candidate (by id). Scores are inner products in double precision; ties go to
    the smaller id. All rows are indexed; only the probing limit is learned on a sample.

    Rows without an id, and vectors that are null, empty, zero or hold null or
    non-finite numbers, take no part, nor do those of another length than most have.
    Equal ids stand for one candidate, with the best of its scores. Other columns are
    ignored. Ids are integers.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(df[id_col].cast("bigint").alias("_id"), df[vector_col].cast("array<double>").alias("_v"))
        finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return rows.filter(F.col("_id").isNotNull() & finite & F.exists("_v", lambda x: x != 0))

    known = usable(vectors)
    lengths = known.groupBy(F.size("_v").alias("_size")).agg(
        F.count("*").alias("_rows"), F.max(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)).alias("_square")
    )
    most = lengths.orderBy(F.desc("_rows"), "_size").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double, visited bigint"
    if most is None:
        return spark.createDataFrame([], schema)
    dimension, total, norm = most["_size"], most["_rows"], float(np.sqrt(most["_square"])) or 1.0
    known = known.filter(F.size("_v") == dimension)
    asked = usable(queries).filter(F.size("_v") == dimension)
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).toArrow()
    hashing = fit(_matrix(sample.column("_v").combine_chunks(), dimension), total, norm, k)

    index = shared_table(indexed(known, hashing, dimension), "index")
    sizes = index.groupBy("_table", "_key").agg(F.ceil(F.count("*") / PART_ROWS).alias("_parts"))
    sizes = shared_table(sizes, "buckets")
    part = F.pmod(F.xxhash64("_id"), F.coalesce("_parts", F.lit(1).cast("bigint"))).alias("_part")
    full = sizes.filter("_parts > 1")
    points = index.join(full, ["_table", "_key"], "left").select("_table", "_key", part, "_id", "_v")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part")

    def probed(rows: DataFrame, places_: slice = slice(None)) -> DataFrame:
        met = probing(rows, hashing, dimension, places_).join(sizes, ["_table", "_key"])
        met = met.select("_table", "_key", every, "_id", "_v", "_least")
        return shared_table(met_in_buckets(points, met, dimension, k), "candidates")

    bounds = {"_above": F.lit(-1.0), "_limit": F.lit(hashing.limit)}
    found = probed(asked.withColumns({**bounds, "_least": F.lit(float("-inf"))}), slice(FIRST))
    later = with_least(asked, best_of(found, k), k).withColumns(bounds)
    found = found.unionByName(probed(later, slice(FIRST, None)))
    more = going_on(with_least(asked, best_of(found, k), k), hashing, dimension)
    more = shared_table(more, "more")
    finite = F.col("_limit") < float("inf")
    found = found.unionByName(probed(more.filter(finite)))

    blocks = F.lit(max(1, -(-total // PART_ROWS))).cast("bigint")
    block = F.pmod(F.xxhash64("_id"), blocks).alias("_key")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("_key")
    one = [F.lit(0).alias("_table"), F.lit(0).cast("bigint").alias("_part")]
    rest = more.filter(~finite).select("_id", "_v", "_least", each, *one)
    scanned = met_in_buckets(known.select("_id", "_v", block, *one), rest, dimension, k)
    found = found.unionByName(shared_table(scanned, "candidates"))
    visited = found.groupBy("query_id").agg(F.sum("visited").alias("visited"))
    return best_of(found, k).join(visited, "query_id").select("query_id", "rank", "vec_id", "score", "visited")
