"""Removing repeated substrings by bucket-pointer refinement (operator 7).

Every string of ``WINDOW`` bytes has an anchor: the place of its least q-gram hash. Equal
strings have equal anchors, so anchors whose q-gram occurs once settle their strings, and
only the text around the others moves. The strings of an anchor in a row are its context.
Contexts found twice are repeated whole. The others, in groups of one q-gram, go through
a suffix sort down to ``WINDOW`` bytes: places are put in buckets by their first bytes,
and a bucket is split by the buckets of later places, which reuses what is split
already and doubles the length each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_tables, mix64, release_shuffles, shared_table, text_blocks

WINDOW = 200
GRAM = 32
PIECE = 1_000_000  # longer texts are cut here; the strings of a cut stay whole
# Groups of one q-gram with more bytes of contexts than that are not sorted: their strings
# meet by digest, as rows that are counted before they move.
CHUNK = 4_000_000
# Smaller groups are sorted together, up to that many bytes at a time: a sort takes some
# 40 bytes of memory for each.
TOGETHER = 1_000_000

_BASE = 0x9E6C63D0876A9A47
_BYTE = mix64(np.arange(256)) | np.uint64(1)
_MASK = np.uint64(2**31 - 1)
_powers = np.ones(0, dtype=np.uint64)
_inverse = np.ones(0, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < size:
        step = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size, pow(_BASE, -1, 2**64), dtype=np.uint64)
        step[0] = back[0] = 1
        _powers, _inverse = np.cumprod(step), np.cumprod(back)
    return _powers[:size], _inverse[:size]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A rolling hash of the ``GRAM`` bytes from each place."""
    powers, inverse = _power_tables(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers)])
    count = len(data) - GRAM + 1
    return mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[:count])


def pieces(texts: list[bytes | None]) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray]]:
    """Blocks of pieces ``(text, offset in it, size)`` and their bytes one after another.
    Pieces of a text overlap by ``WINDOW - 1`` bytes: each string is in one of them."""
    held: list[tuple[int, int, int]] = []
    parts: list[bytes] = []
    size = 0
    for number, text in enumerate(texts):
        text = text or b""
        for offset in range(0, max(len(text) - WINDOW + 1, 0), PIECE):
            part = text[offset : offset + PIECE + WINDOW - 1]
            held.append((number, offset, len(part)))
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield held, np.frombuffer(b"".join(parts), dtype=np.uint8)
                held, parts, size = [], [], 0
    if held:
        yield held, np.frombuffer(b"".join(parts), dtype=np.uint8)


def anchors(held: list[tuple[int, int, int]], data: np.ndarray) -> tuple[np.ndarray, ...]:
    """For a block: the piece, the place and the hash of each anchor, and the first and
    last place whose string it anchors (places in the block)."""
    hashes = gram_hashes(data)
    # The hash decides, and among equal ones the place.
    least = (hashes & ~_MASK) | np.arange(len(hashes), dtype=np.uint64)
    width, span = 1, WINDOW - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    sizes = np.array([size for _, _, size in held])
    ends = np.cumsum(sizes)
    inside = np.ones(len(data), dtype=bool)
    for end in ends.tolist():
        inside[end - WINDOW + 1 : end] = False
    places = np.flatnonzero(inside[: len(least)])
    at = (least[places] & _MASK).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last = places[new], places[np.append(new[1:], len(places)) - 1]
    at = at[new]
    return np.searchsorted(ends, at, side="right"), at, hashes[at].view(np.int64), first, last


def anchor_rows(documents: DataFrame) -> DataFrame:
    """``(h, row, pos)`` for the anchors of ``(_row, _text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (block for batch in batches for block in text_blocks(batch, 1)):
            rows = part.column(0).to_numpy()
            for held, data in pieces(texts):
                piece, at, hashes, _, _ = anchors(held, data)
                number, offset, size = (np.array(x) for x in zip(*held))
                start = np.cumsum(size) - size
                yield pa.RecordBatch.from_pydict(
                    {"h": hashes, "row": rows[number[piece]], "pos": at - start[piece] + offset[piece]}
                )

    return documents.mapInArrow(run, "h bigint, row bigint, pos bigint")


def context_rows(documents: DataFrame, id_type: str) -> DataFrame:
    """``(h, d, _id, _hash, start, size, bytes)`` for the contexts of the anchors at
    ``_places`` of ``(_id, _hash, _text, _places)``; ``d`` is a digest of the bytes and
    of the anchor's place in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (block for batch in batches for block in text_blocks(batch, 2)):
            ids, text_hashes = part.column(0), part.column(1).to_numpy()
            wanted = part.column(3)
            for held, data in pieces(texts):
                piece, at, hashes, first, last = anchors(held, data)
                number, offset, size = (np.array(x) for x in zip(*held))
                begin = np.cumsum(size) - size
                own = number[piece]
                place = at - begin[piece] + offset[piece]
                keep = np.zeros(len(at), dtype=bool)
                edges = np.searchsorted(own, np.arange(own[0], own[-1] + 2))
                for text, low, high in zip(range(own[0], own[-1] + 1), edges, edges[1:]):
                    if high > low:
                        keep[low:high] = np.isin(place[low:high], wanted[text].values.to_numpy())
                raw = data.tobytes()
                chosen = np.flatnonzero(keep)
                bodies = [raw[a : b + WINDOW] for a, b in zip(first[chosen].tolist(), last[chosen].tolist())]
                leads = (at - first)[chosen].tolist()
                digests = [
                    hashlib.blake2b(body, digest_size=16, salt=lead.to_bytes(8, "little")).digest()
                    for body, lead in zip(bodies, leads)
                ]
                start = first - begin[piece] + offset[piece]
                yield pa.RecordBatch.from_pydict(
                    {
                        "h": hashes[chosen],
                        "d": pa.array(digests, pa.binary()),
                        "_id": ids.take(pa.array(own[chosen])),
                        "_hash": text_hashes[own[chosen]],
                        "start": start[chosen],
                        "size": [len(body) for body in bodies],
                        "bytes": pa.array(bodies, pa.binary()),
                    }
                )

    fields = f"h bigint, d binary, _id {id_type}, _hash bigint, start bigint, size bigint, bytes binary"
    return documents.mapInArrow(run, fields)


def _buckets(keys: np.ndarray) -> np.ndarray:
    """Numbers of the distinct keys, -1 for a key that is there once."""
    order = np.argsort(keys)
    ranked = keys[order]
    edge = np.ones(len(keys) + 1, dtype=bool)
    edge[1:-1] = ranked[1:] != ranked[:-1]
    del ranked
    new, alone = edge[:-1], edge[:-1] & edge[1:]
    names = np.cumsum(new & ~alone, dtype=np.int32) - np.int32(1)
    names[alone] = -1
    out = np.empty(len(keys), dtype=np.int32)
    out[order] = names
    return out


def repeated_places(data: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of ``data`` whose next ``window`` bytes are those from another place too.

    ``ends`` gives for each place the end of the stretch that it may use. Places are put
    into buckets by eight bytes; buckets of 2m bytes come from pairs of buckets of m
    bytes, m apart, and the last ones overlap. Places alone in their bucket drop out.
    Places and buckets are 32-bit numbers.
    """
    size = len(data)
    reach = 8
    room = ends.astype(np.int32) - np.arange(size, dtype=np.int32)
    live = np.flatnonzero(room >= reach).astype(np.int32)
    first = np.zeros(size, dtype=np.uint64)
    for i in range(min(reach, size)):
        first <<= np.uint64(8)
        first[: size - i] |= data[i:]
    keys = first[live]
    del first
    bucket = np.full(size, -1, dtype=np.int32)
    bucket[live] = _buckets(keys)
    while reach < window:
        step = min(reach, window - reach)
        live = live[bucket[live] >= 0]
        live = live[room[live] >= reach + step]
        later = bucket[live + step]
        live, later = live[later >= 0], later[later >= 0]
        keys = (bucket[live].astype(np.int64) << 32) | later
        del later
        bucket.fill(-1)
        bucket[live] = _buckets(keys)
        reach += step
    return live[bucket[live] >= 0].astype(np.int64)


def _intervals(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes, given places in ascending order."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) > WINDOW)
    return places[np.concatenate([[0], cut + 1])], places[np.append(cut, len(places) - 1)] + WINDOW


def whole_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows with up to ``limit`` bytes in the last column, or one group with more;
    the rows of a group have equal first columns and follow one another."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(0).to_numpy()
        ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(), dtype=np.int64)
        begins = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        parts = np.diff(ends[np.append(begins[1:], len(groups)) - 1], prepend=0)
        low = 0
        for begin, part in zip(begins.tolist(), parts.tolist()):
            # A group that went on from the batch before is not cut.
            if size and size + part > limit and (begin or groups[0] != last):
                yield [*held, batch.slice(low, begin - low)]
                held, size, low = [], 0, begin
            size += part
        held.append(batch.slice(low))
        last = groups[-1]
    if held:
        yield held


def sorted_contexts(contexts: DataFrame, id_type: str) -> DataFrame:
    """``(_id, _hash, start, end)``: repeated stretches of contexts that occur once.

    ``contexts`` ``(h, n, _id, _hash, start, bytes)`` are distinct, grouped by ``h`` in
    partitions. A task sorts whole groups, about ``TOGETHER`` bytes at a time.
    """

    def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        bodies = table["bytes"].to_pylist()
        data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        sizes = np.array([len(body) for body in bodies])
        ends = np.cumsum(sizes)
        del bodies
        found = repeated_places(data, np.repeat(ends.astype(np.int32), sizes))
        owner = np.searchsorted(ends, found, side="right")
        once = table["n"].to_numpy() == 1
        start = table["start"].to_numpy()
        found, owner = found[once[owner]], owner[once[owner]]
        which, low, high = [], [], []
        edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
        for a, b in zip(edges, [*edges[1:], len(owner)]):
            context = int(owner[a])
            begins, stops = _intervals(found[a:b] - (ends[context] - sizes[context]))
            which += [context] * len(begins)
            low += (begins + start[context]).tolist()
            high += (stops + start[context]).tolist()
        taken = table.take(pa.array(which, pa.int64())).combine_chunks()
        return pa.RecordBatch.from_pydict(
            {
                "_id": taken["_id"].combine_chunks(),
                "_hash": taken["_hash"].combine_chunks(),
                "start": pa.array(low, pa.int64()),
                "end": pa.array(high, pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, TOGETHER):
            yield work(rows)

    fields = f"_id {id_type}, _hash bigint, start bigint, end bigint"
    return contexts.select("h", "n", "_id", "_hash", "start", "bytes").mapInArrow(run, fields)


def counted_strings(contexts: DataFrame, id_type: str) -> DataFrame:
    """As ``sorted_contexts``, for groups of any size: each string is a row by its
    digest, and rows are counted before and after they are brought together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for times, own, text_hash, start, body in zip(*columns):
                places = range(len(body) - WINDOW + 1)
                digests = [hashlib.blake2b(body[i : i + WINDOW], digest_size=16).digest() for i in places]
                yield pa.RecordBatch.from_pydict(
                    {
                        "w": pa.array(digests, pa.binary()),
                        "n": [times] * len(digests),
                        "_id": pa.array([own] * len(digests), batch.column(1).type),
                        "_hash": [text_hash] * len(digests),
                        "start": [start + i for i in places],
                    }
                )

    fields = f"w binary, n bigint, _id {id_type}, _hash bigint, start bigint"
    strings = contexts.select("n", "_id", "_hash", "start", "bytes").mapInArrow(run, fields)
    strings = shared_table(strings, "substrings-strings")
    repeated = strings.groupBy("w").agg(F.sum("n").alias("_times")).filter("_times > 1")
    found = strings.filter("n = 1").join(repeated, "w")
    return found.select("_id", "_hash", "start", (F.col("start") + WINDOW).alias("end"))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``(_id, _hash, _spans)`` for the rows ``(_row, _id, _hash, _text)`` that hold a
    repeated string: the stretches of bytes to remove, not merged yet."""
    spark = documents.sparkSession
    id_type = documents.schema["_id"].dataType.simpleString()
    found = shared_table(anchor_rows(documents.select("_row", "_text")), "substrings-anchors")
    twice = found.groupBy("h").agg(F.count("*").alias("_times")).filter("_times > 1").select("h")
    places = found.join(twice, "h").groupBy("row").agg(F.collect_list("pos").alias("_places"))
    places = shared_table(places.withColumnRenamed("row", "_row"), "substrings-places")
    drop_tables(found)
    release_shuffles(spark)

    texts = documents.join(places, "_row").select("_id", "_hash", "_text", "_places")
    contexts = shared_table(context_rows(texts, id_type), "substrings-contexts", "zstd")
    drop_tables(places)
    release_shuffles(spark)
    one = F.min(F.struct("_id", "_hash", "start")).alias("_one")
    size = F.max("size").alias("_size")
    distinct = contexts.groupBy("h", "d").agg(F.count("*").alias("n"), size, one)
    distinct = shared_table(distinct, "substrings-distinct")
    groups = distinct.groupBy("h").agg(
        F.count("*").alias("_many"), F.min("n").alias("_least"), F.sum("_size").alias("_whole")
    )
    mixed = groups.filter("_many > 1 AND _least = 1").select("h", "_whole")
    mixed = distinct.join(mixed, "h").select("d", "n", "_one", "_whole")
    bodies = contexts.select("h", "d", "_id", "_hash", "start", "bytes").join(mixed, "d")
    bodies = bodies.filter(F.struct("_id", "_hash", "start").eqNullSafe(F.col("_one")))
    bodies = shared_table(bodies.drop("d", "_one"), "substrings-mixed", "zstd")
    release_shuffles(spark)

    small = bodies.filter(F.col("_whole") <= CHUNK).repartition("h").sortWithinPartitions("h")
    large = bodies.filter(F.col("_whole") > CHUNK)
    whole = contexts.select("d", "_id", "_hash", "start", (F.col("start") + F.col("size")).alias("end"))
    whole = whole.join(distinct.filter("n > 1").select("d"), "d").drop("d")
    spans = whole.unionByName(sorted_contexts(small, id_type)).unionByName(counted_strings(large, id_type))
    spans = spans.groupBy("_id", "_hash").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    spans = shared_table(spans, "substrings-spans")
    drop_tables(contexts, distinct, bodies)
    release_shuffles(spark)
    return spans


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a ``WINDOW``-byte string that starts anywhere else too.

    Returns ``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row: the
    maximal removed runs are counted, ``kept`` is what is left, as bytes. Strings are
    judged on the input, overlaps count, none crosses from one row to another.

    A null text is empty. Rows that are the same throughout repeat each other, as any
    others do. Ids may be null or repeat. Other columns are ignored. Texts are taken
    whole: long ones are worked through in overlapping pieces.
    """
    rows = documents.select(documents[id_col].alias("_id"), documents[text_col].alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    rows = rows.withColumn("_hash", F.xxhash64("_text")).withColumn("_row", F.xxhash64("_id", "_text"))
    spans = repeated_spans(rows).select(F.col("_id").alias("_of"), F.col("_hash").alias("_of_hash"), "_spans")
    same = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_of_hash"))
    rows = rows.join(spans, same, "left").select(
        "_id", "_text", F.col("_spans.start").alias("_starts"), F.col("_spans.end").alias("_ends")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (block for batch in batches for block in text_blocks(batch, 1)):
            texts = [text or b"" for text in texts]
            removed, runs, kept = [], [], []
            for text, starts, ends in zip(texts, part.column(2), part.column(3)):
                parts, done, count = [], 0, 0
                if starts.is_valid:
                    starts, ends = starts.values.to_numpy(), ends.values.to_numpy()
                    order = np.argsort(starts, kind="stable")
                    starts, ends = starts[order], np.maximum.accumulate(ends[order])
                    new = np.concatenate([[True], starts[1:] > ends[:-1]])
                    stops = ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]
                    for low, high in zip(starts[new].tolist(), stops.tolist()):
                        parts.append(text[done:low])
                        done, count = high, count + 1
                parts.append(text[done:])
                kept.append(b"".join(parts))
                removed.append(len(text) - len(kept[-1]))
                runs.append(count)
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: part.column(0),
                    "n_bytes": [len(text) for text in texts],
                    "n_removed": removed,
                    "n_spans": runs,
                    "kept_sha256": [hashlib.sha256(body).hexdigest() for body in kept],
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, {fields}")
