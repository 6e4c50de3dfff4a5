"""N-gram Jaccard join by rare-first prefixes (operator 13).

All shingles have one order, from rare to frequent. Two sets that are similar enough then
share a shingle among the first few of each, their prefixes; documents meet in the lists of
equal prefix shingles. There the sizes and the places of the shingle bound the overlap
(length and positional filter), then counts of the shingles by class (suffix filter). Pairs
that are left are distinct and are verified once, on the sets of the whole texts.

Equal sets are one node from the start. Each list first compares its members with the one
that has the shingle earliest, which has the fewest shingles of its own. What that links is
one component, and only pairs between components of a list are joined after that.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, shared_table, text_blocks
from tidemark.llm.neardup import components, shingle_sets

SHINGLE = 3
SIMILARITY = 90  # percent
# Documents are counted per cell of shingle hashes, for the order only: any order that all
# documents have in common is right, and a shingle never counts less than it should. The
# table has a fixed size whatever the input, and goes to every executor (8 MB).
CELLS = 1 << 21
_CHUNKS = 64
# Classes of the suffix filter.
CLASSES = 64
# Sets that a hub is compared with by one task at least; a bigger hub is split.
HUB = 512
# Bits of the filter that keeps texts from moving whose sets nobody asks for (1 MB).
FILTER_BITS = 1 << 23


def least_overlap(n: Column, m: Column, overlap: Column) -> Column:
    """Sets of ``n`` and ``m`` with this many in common are similar enough."""
    return (100 + SIMILARITY) * overlap >= SIMILARITY * (n + m)


def prefix_size(n: int) -> int:
    """As many of the first shingles as hold a common one with any linked set."""
    return n - -(-n * SIMILARITY // 100) + 1


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def document_counts(documents: DataFrame, text_col: str, width: int) -> np.ndarray:
    """How many documents hold a shingle of each cell, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for _, texts in text_blocks(batch, 0):
                sets = shingle_sets(texts, width)
                counts += np.bincount(_cell(np.concatenate(sets)), minlength=CELLS)
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(counts, _CHUNKS)]
        yield pa.RecordBatch.from_pydict(
            {"_chunk": pa.array(range(_CHUNKS), pa.int32()), "_counts": pa.array(parts, pa.binary())}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch["_chunk"].to_pylist(), batch["_counts"].to_pylist()):
                counts = np.frombuffer(zlib.decompress(part), dtype=np.int64)
                sums[chunk] = sums[chunk] + counts if chunk in sums else counts
        parts = [zlib.compress(counts.tobytes(), 1) for counts in sums.values()]
        yield pa.RecordBatch.from_pydict(
            {"_chunk": pa.array(list(sums), pa.int32()), "_counts": pa.array(parts, pa.binary())}
        )

    schema = "_chunk int, _counts binary"
    made = documents.select(documents[text_col]).mapInArrow(count, schema)
    total = np.zeros((_CHUNKS, CELLS // _CHUNKS), dtype=np.int64)
    for row in made.repartition(_CHUNKS, "_chunk").mapInArrow(add, schema).collect():
        total[row["_chunk"]] = np.frombuffer(zlib.decompress(row["_counts"]), dtype=np.int64)
    return np.minimum(total.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def class_counts(hashes: np.ndarray) -> bytes:
    """How many shingles are in each class, in as few bytes a class as hold them."""
    counts = np.bincount(hashes & (CLASSES - 1), minlength=CLASSES)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if counts.max() <= np.iinfo(k).max)
    return counts.astype(kind).tobytes()


def _class_table(column: pa.Array) -> np.ndarray:
    kinds = {CLASSES: np.uint8, 2 * CLASSES: np.uint16, 4 * CLASSES: np.uint32}
    rows = [np.frombuffer(x, kinds[len(x)]).astype(np.int64) for x in column.to_pylist()]
    return np.array(rows, dtype=np.int64).reshape(len(rows), CLASSES)


def _digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def prefixes(documents: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``(id, n_shingles, _digest, _prefix, _classes)`` of every document."""
    counts = document_counts(documents, text_col, width)
    order = documents.sparkSession.sparkContext.broadcast(counts)

    def work(texts: list[bytes | None]) -> dict[str, list]:
        sets = shingle_sets(texts, width)
        # The sets are sorted, so equal counts go by the hash.
        first = [
            s[np.argsort(order.value[_cell(s)], kind="stable")[: prefix_size(len(s))]] for s in sets
        ]
        return {
            "n_shingles": list(map(len, sets)),
            "_digest": pa.array(list(map(_digest, sets)), pa.binary()),
            "_prefix": pa.array(first, pa.list_(pa.int64())),
            "_classes": pa.array([class_counts(s) for s in sets], pa.binary()),
        }

    fields = "n_shingles bigint, _digest binary, _prefix array<bigint>, _classes binary"
    return map_texts(documents, id_col, text_col, fields, work)


def places(nodes: DataFrame) -> DataFrame:
    """``(_token, _k, _n, _pos)``: the prefixes as rows of inverted lists."""
    return nodes.select("_k", "_n", F.posexplode("_prefix")).select(
        F.col("col").alias("_token"), "_k", "_n", F.col("pos").alias("_pos")
    )


def possible(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Length and positional filter: what two sets can share from these places on."""
    return least_overlap(n, m, F.least(n - i, m - j))


def star_pairs(lists: DataFrame) -> DataFrame:
    """``(_a, _b)``: each member of a list with ``_b``, the one that has it earliest."""
    leaders = lists.groupBy("_token").agg(
        F.min(F.struct("_pos", "_k", "_n")).alias("_lead"), F.count("*").alias("_held")
    )
    leaders = shared_table(leaders.filter("_held > 1").select("_token", "_lead"), "leaders")
    lead = {name: F.col(f"_lead.{name}") for name in ("_k", "_n", "_pos")}
    pairs = lists.join(leaders, "_token").filter(F.col("_k") != lead["_k"])
    pairs = pairs.filter(possible(F.col("_n"), F.col("_pos"), lead["_n"], lead["_pos"]))
    return pairs.select(F.col("_k").alias("_a"), lead["_k"].alias("_b")).distinct()


def pairs_between(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``(_a, _b)``: all pairs of a list that can be linked and lie in two components.

    The larger set brings its whole prefix, the other one the shorter prefix that suffices
    then. Members of a list's largest component do not meet each other.
    """
    named = labels.select(F.col("_node").alias("_k"), "_label")
    lists = lists.join(named, "_k", "left").withColumn("_label", F.coalesce("_label", "_k"))
    spread = lists.groupBy("_token").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"))
    open_tokens = shared_table(spread.filter("_low <> _high").select("_token"), "open")
    members = shared_table(lists.join(open_tokens, "_token"), "members")
    sizes = members.groupBy("_token", "_label").agg(F.count("*").alias("_held"))
    main = sizes.groupBy("_token").agg(F.max(F.struct("_held", "_label")).alias("_main"))
    main = shared_table(main.select("_token", F.col("_main._label").alias("_main")), "main")
    members = shared_table(members.join(main, "_token"), "members")

    inside = F.col("_label") == F.col("_main")
    short = least_overlap(F.col("_n"), F.col("_n"), F.col("_n") - F.col("_pos"))
    index = members.filter(short).select(
        "_token", *[F.col(c).alias(c + "1") for c in ("_k", "_n", "_pos", "_label")], inside.alias("_in1")
    )

    def meet(probes: DataFrame, index: DataFrame) -> DataFrame:
        met = probes.drop("_main").join(index, "_token")
        met = met.filter((F.col("_label") != F.col("_label1")) & (F.col("_n") >= F.col("_n1")))
        met = met.filter(possible(F.col("_n"), F.col("_pos"), F.col("_n1"), F.col("_pos1")))
        return met.select(F.least("_k", "_k1").alias("_a"), F.greatest("_k", "_k1").alias("_b"))

    others = meet(members.filter(~inside), index)
    return others.union(meet(members.filter(inside), index.filter(~F.col("_in1")))).distinct()


def suffix_filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that can share enough by the counts of their shingles per class.

    Classes are the same for all sets, so that two sets share at most the lesser count of
    each. The counts are of the whole sets, which the suffixes are part of.
    """
    for end in ("_a", "_b"):
        named = nodes.select(
            F.col("_k").alias(end), F.col("_n").alias("_n" + end), F.col("_classes").alias("_c" + end)
        )
        pairs = pairs.join(named, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = np.minimum(_class_table(batch["_c_a"]), _class_table(batch["_c_b"])).sum(axis=1)
            n, m = batch["_n_a"].to_numpy(), batch["_n_b"].to_numpy()
            fine = pa.array((100 + SIMILARITY) * shared >= SIMILARITY * (n + m))
            yield batch.select(["_a", "_b"]).filter(fine)

    return pairs.mapInArrow(run, "_a bigint, _b bigint")


def asked_for(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """``rows`` less most of those whose ``name`` is not in ``wanted``.

    Values of ``wanted`` set bits of a map of fixed size, by hash; it keeps every row that
    is asked for, and others where bits collide. So it only saves moving rows to a join.
    """
    bit = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits")
    )
    place = F.bitmap_bit_position(bit)
    rows = rows.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bits), "_bucket")
    byte = F.expr("CAST(conv(hex(substring(_bits, CAST(_place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    held = rows.withColumn("_place", place).filter(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_place % 8 AS INT))")) != 0)
    return held.drop("_bucket", "_bits", "_place")


def verified(
    pairs: DataFrame, nodes: DataFrame, documents: DataFrame, id_col: str, text_col: str, width: int
) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    The sets of all partners of a hub ``_b`` go where the hub's own set is, in groups of
    about ``HUB``; a task holds the hub's set and one other.
    """
    hubs = pairs.groupBy("_b").agg(F.count("*").alias("_many"))
    hubs = hubs.withColumn("_parts", F.ceil(F.col("_many") / HUB))
    spread = pairs.join(hubs, "_b").withColumn("_part", F.pmod(F.xxhash64("_a"), F.col("_parts")))
    partners = spread.select(F.col("_a").alias("_k"), "_b", "_part", F.lit(1).alias("_role"))
    own = hubs.select(
        F.col("_b").alias("_k"), "_b", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"),
        F.lit(0).alias("_role"),
    )
    wanted = partners.union(own).join(nodes.select("_k", "_rep", "_digest"), "_k")
    wanted = shared_table(wanted, "wanted")
    rows = documents.select(documents[id_col].alias("_rep"), documents[text_col].alias("_text"))
    rows = asked_for(rows, wanted, "_rep")
    rows = rows.join(wanted, "_rep").select("_text", "_digest", "_k", "_b", "_part", "_role")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch, 0):
                # Rows of one text follow each other.
                fresh = [i for i, t in enumerate(texts) if i == 0 or t != texts[i - 1]]
                made = shingle_sets([texts[i] for i in fresh], width)
                names = list(map(_digest, made))
                which = np.searchsorted(fresh, np.arange(len(texts)), side="right") - 1
                # An id may have several texts; the others are not the node's.
                mine = [i for i, d in enumerate(part["_digest"].to_pylist()) if names[which[i]] == d]
                out = part.select(["_k", "_b", "_part", "_role"]).take(pa.array(mine, pa.int64()))
                column = pa.array([made[which[i]].tobytes() for i in mine], pa.binary())
                yield pa.RecordBatch.from_arrays([*out.columns, column], [*out.schema.names, "_set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, np.zeros(0, dtype=np.int64)
        for batch in batches:
            found = []
            sizes = zip(*[batch[c].to_pylist() for c in ("_k", "_b", "_part", "_role")], batch["_set"])
            for k, b, part, role, data in sizes:
                held = np.frombuffer(data.as_buffer(), dtype=np.int64)
                if role == 0:
                    at, hub = (b, part), held.copy()
                elif at == (b, part):
                    both = np.intersect1d(held, hub, assume_unique=True).size
                    if (100 + SIMILARITY) * both >= SIMILARITY * (len(held) + len(hub)):
                        found.append((k, b))
            yield pa.RecordBatch.from_pydict(
                {"_a": pa.array([x[0] for x in found], pa.int64()), "_b": pa.array([x[1] for x in found], pa.int64())}
            )

    made = rows.mapInArrow(sets, "_k bigint, _b bigint, _part bigint, _role int, _set binary")
    met = made.repartition("_b", "_part").sortWithinPartitions("_b", "_part", "_role")
    return met.mapInArrow(compare, "_a bigint, _b bigint").distinct()


def ngram_join(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``documents``.

    Shingles are ``width`` words with A-Z in lower case; a text of fewer words is one
    shingle. Documents link where their sets have a Jaccard similarity of ``SIMILARITY``
    percent or more; ``component_id`` is the least id reachable.

    Texts without words, null ones included, link with nothing and are their own component.
    Rows without an id link nothing: their component is that of equal sets with an id, or
    null. Ids may repeat, and each row goes by its own text. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    source = documents.select(documents[id_col], documents[text_col])
    own = shared_table(prefixes(source, id_col, text_col, width), "prefixes")
    nodes = own.filter("_digest IS NOT NULL").groupBy("_digest").agg(
        F.min(id_col).alias("_rep"),
        F.max("n_shingles").alias("_n"),
        F.first("_prefix").alias("_prefix"),
        F.first("_classes").alias("_classes"),
    )
    nodes = nodes.filter("_rep IS NOT NULL").withColumn("_k", F.monotonically_increasing_id())
    nodes = shared_table(nodes, "nodes")
    lists = places(nodes)
    texts = (nodes, source, id_col, text_col, width)

    tested = shared_table(suffix_filtered(star_pairs(lists), nodes), "pairs")
    links = shared_table(verified(tested, *texts), "links")
    between = pairs_between(lists, components(links))
    known = tested.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"))
    rest = shared_table(suffix_filtered(between.join(known, ["_a", "_b"], "left_anti"), nodes), "pairs")
    links = shared_table(links.union(verified(rest, *texts)), "links")

    labels = components(links).withColumnRenamed("_node", "_k")
    groups = labels.join(nodes.select("_k", "_rep", "_digest"), "_k")
    least = groups.groupBy("_label").agg(F.min("_rep").alias("_least"))
    linked = groups.join(least, "_label").select("_k", "_least")
    named = nodes.select("_digest", "_k", "_rep").join(linked, "_k", "left")
    named = named.select("_digest", F.coalesce("_least", "_rep").alias("component_id"))
    out = own.select(id_col, "n_shingles", "_digest").join(named, "_digest", "left")
    component = F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col(id_col)))
    return out.select(id_col, "n_shingles", component.alias("component_id"))
