"""Near-duplicates by bottom-k sketches of word shingles (operator 9).

Documents with equal shingle sets are one node from the start. Nodes meet in inverted
lists of retained values: the keys are runs of neighbouring values in the sketches, which
two sets with a Jaccard similarity of 3/4 share (see ``RUN``). A list does not emit its
pairs. Each member is compared with one leader of the list, first by the sketches' union,
then by the full sets, and what is linked becomes one component. Only lists that still
hold several components go on: their members meet again by their rarest shingles, of
which linked sets must share one, and there every pair of components is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    byte_blocks,
    drop_tables,
    map_texts,
    mix64,
    release_shuffles,
    shared_table,
    text_bytes,
)

SHINGLE = 5
SKETCH = 64
# Linked sets share at least 3 of 4 values of their union. If the whole sets are
# retained, three neighbouring values of the union are then in both whenever the union
# has nine values or more, and two otherwise: fewer others cannot break up all runs.
# If not, the chance of no such run among 64 values is below one in a million.
RUN = 3
SMALL = 8
SIMILARITY = 75  # percent
# The share of the union sketch in both sets lies below this for a linked pair with a
# chance of less than one in a hundred million (64 draws, 3 of 4 hits).
LEAST_ESTIMATE = 0.42

_BASE = np.uint64(0x9E6C63D0876A9A47)
WORD_BYTES = 64  # longer words are hashed whole
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z in lower case, and the number of words in each text.

    Eight bytes of every word are mixed in at a time; long words are hashed one by one.
    """
    data = b" ".join([b"", *(text or b"" for text in texts), bytes(8)]).lower()
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)][:-8]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    bounds = np.cumsum([1, *(len(text or b"") + 1 for text in texts)])
    counts = np.diff(np.searchsorted(starts, bounds))
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    hashes = sizes.astype(np.uint64)
    for at in range(0, WORD_BYTES, 8):
        live = np.flatnonzero(sizes > at) if at else slice(None)
        part = eight[starts[live] + at] & _MASKS[np.minimum(sizes[live] - at, 8)]
        hashes[live] = mix64(hashes[live] * _BASE + part)
    for word in np.flatnonzero(sizes > WORD_BYTES):
        whole = data[starts[word] : starts[word] + sizes[word]]
        hashes[word] = xxhash.xxh3_64_intdigest(whole)
    return hashes, counts


def shingle_sets(
    texts: list[bytes | None], width: int = SHINGLE, counts: list[int] | None = None
) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as signed 64-bit integers.

    The words of all texts are hashed in one go. ``counts`` gets their numbers of words.
    """
    ids, n = word_hashes(texts)
    if counts is not None:
        counts += n.tolist()
    ends = np.cumsum(n)
    hashes = np.zeros(max(0, len(ids) - width + 1), dtype=np.uint64)
    for i in range(width):
        hashes = mix64(hashes * _BASE + ids[i : len(hashes) + i])
    inside = np.arange(len(hashes)) + width <= np.repeat(ends, n)[: len(hashes)]
    hashes = hashes[inside].view(np.int64)
    stops = np.cumsum(np.maximum(n - width + 1, 0))
    new = np.ones(len(hashes), dtype=bool)
    for start, stop in zip(stops - np.maximum(n - width + 1, 0), stops):
        hashes[start:stop].sort()
    new[1:] = hashes[1:] != hashes[:-1]
    new[stops[:-1][stops[:-1] < len(hashes)]] = True
    kept = np.concatenate([[0], np.cumsum(new)])[np.concatenate([[0], stops])]
    out = np.split(hashes[new], kept[1:-1]) if len(texts) else []
    for at in np.flatnonzero((n > 0) & (n < width)):
        short = np.full(1, n[at] + 1, dtype=np.uint64)
        for i in range(ends[at] - n[at], ends[at]):
            short = mix64(short * _BASE + ids[i])
        out[at] = short.view(np.int64)
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([*arrays, np.zeros(0, dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _node(hashes: np.ndarray) -> bytes | None:
    """The name of a set: a digest of it; none for the empty set."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _text_hash(text: bytes | None) -> int:
    return 42 if text is None else xxhash.xxh64_intdigest(text, seed=42)


def sketches(
    documents: DataFrame, id_col: str, text_col: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``(id, keep, n_shingles, _words, _null, _hash, _node, _sketch)``: the least ``SKETCH``
    hashes of each set; ``_hash`` is Spark's xxhash64 of the text."""

    def work(texts: list[bytes | None]) -> dict[str, list]:
        words: list[int] = []
        sets = shingle_sets(texts, counts=words)
        return {
            "n_shingles": list(map(len, sets)),
            "_words": words,
            "_null": [text is None for text in texts],
            "_hash": np.array(list(map(_text_hash, texts)), dtype=np.uint64).view(np.int64),
            "_node": pa.array(list(map(_node, sets)), pa.binary()),
            "_sketch": _lists([s[:SKETCH] for s in sets]),
        }

    fields = (
        "n_shingles bigint, _words bigint, _null boolean, _hash bigint, _node binary, "
        "_sketch array<bigint>"
    )
    return map_texts(documents, id_col, text_col, fields, work, keep)


def full_sets(documents: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_node, _set)`` for ``nodes`` ``(_node, _rep)``, from the documents ``_rep``."""
    rows = documents.select(documents[id_col].alias("_rep"), documents[text_col].alias("_text"))
    rows = rows.join(nodes.select("_rep").distinct(), "_rep", "left_semi").select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for block in byte_blocks(len(t or b"") for t in texts):
                sets = [s for s in shingle_sets(texts[block]) if len(s)]
                names = pa.array(list(map(_node, sets)), pa.binary())
                yield pa.RecordBatch.from_pydict({"_node": names, "_set": _lists(sets)})

    made = rows.mapInArrow(run, "_node binary, _set array<bigint>")
    return made.dropDuplicates(["_node"]).join(nodes.select("_node"), "_node", "left_semi")


def run_keys(sketch: Column, n: Column) -> Column:
    """The keys of a sketch: its runs of three values, and of two for a small set."""

    def runs(width: int) -> Column:
        last = F.size(sketch) - width
        at = lambda i: F.xxhash64(*[F.element_at(sketch, i + j) for j in range(width)])
        made = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), at)
        return F.when(last >= 0, made).otherwise(F.array().cast("array<bigint>"))

    return F.when(n <= SMALL, F.concat(runs(RUN), runs(2))).otherwise(runs(RUN))


def key_rows(nodes: DataFrame) -> DataFrame:
    """``(_node, _n, _key)``: the values of ``run_keys`` as rows.

    The places are unfolded first, negative ones for runs of two, and hashed row by row in
    Spark's generated code, which does not reach into functions of arrays.
    """
    sketch, last = F.col("_sketch"), F.size("_sketch")

    def places(width: int) -> Column:
        made = F.sequence(F.lit(1), F.greatest(last - width + 1, F.lit(1)))
        return F.when(last >= width, made).otherwise(F.array().cast("array<int>"))

    twos = F.when(F.col("_n") <= SMALL, F.transform(places(2), F.negative))
    both = F.concat(places(RUN), F.coalesce(twos, F.array().cast("array<int>")))
    rows = nodes.select("_node", "_n", "_sketch", F.explode(both).alias("_at"))
    at = F.abs("_at")
    two, three = (
        F.xxhash64(*[F.element_at(sketch, at + j) for j in range(width)]) for width in (2, RUN)
    )
    return rows.select("_node", "_n", F.when(F.col("_at") > 0, three).otherwise(two).alias("_key"))


def estimate(a: Column, b: Column) -> Column:
    """Jaccard similarity by the bottom-k sketch of the union of two sketches."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return both / F.size(union)


def alike(n: Column, m: Column, both: Column) -> Column:
    return 100 * both >= SIMILARITY * (n + m - both)


def near_sizes(n: Column, m: Column) -> Column:
    """The size filter: sets of these sizes can be linked."""
    return 100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(_a, _b)`` whose full sets are similar enough."""
    a = sets.select(F.col("_node").alias("_a"), F.col("_set").alias("_set_a"))
    b = sets.select(F.col("_node").alias("_b"), F.col("_set").alias("_set_b"))
    joined = pairs.join(a, "_a").join(b, "_b")
    both = F.size(F.array_intersect("_set_a", "_set_b"))
    return joined.filter(alike(F.size("_set_a"), F.size("_set_b"), both)).select("_a", "_b")


def hooked(edges: DataFrame) -> DataFrame:
    """``(_node, _label)``: each node of ``edges`` with the least one next to it or, if
    that hooks onto a lesser one itself, with that one: in the same component."""
    both = edges.select("_a", "_b").union(edges.select("_b", "_a"))
    hooks = both.groupBy(F.col("_a").alias("_node")).agg(F.min("_b").alias("_label"))
    hooks = hooks.withColumn("_label", F.least("_node", "_label"))
    ahead = hooks.select(F.col("_node").alias("_label"), F.col("_label").alias("_next"))
    return hooks.join(ahead, "_label", "left").select(
        "_node", F.coalesce("_next", "_label").alias("_label")
    )


def contracted(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges between the labels of their ends, those inside one label left out."""
    for end in ("_a", "_b"):
        named = labels.select(F.col("_node").alias(end), F.col("_label").alias("_to"))
        edges = edges.join(named, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return edges.filter("_a <> _b").select("_a", "_b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(_node, _label)``: the least node reachable over ``links`` ``(_a, _b)``.

    Each round every label hooks onto the least label next to it, and links inside one
    label go; what is left is shorter each time, half the labels at most.
    """
    edges = shared_table(links.filter("_a <> _b").select("_a", "_b").distinct(), "edges")
    labels = shared_table(hooked(edges), "labels")
    hooks = labels
    while True:
        edges = shared_table(contracted(edges, hooks), "edges")
        if edges.isEmpty():
            return labels
        hooks = shared_table(hooked(edges), "hooks")
        moved = hooks.select(F.col("_node").alias("_label"), F.col("_label").alias("_to"))
        labels = labels.join(moved, "_label", "left").select(
            "_node", F.coalesce("_to", "_label").alias("_label")
        )
        labels = shared_table(labels, "labels")


def labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the component of ``_node``, the node itself where it has no link."""
    named = labels.select("_node", F.col("_label").alias("_found"))
    out = df.join(named, "_node", "left")
    return out.withColumn("_label", F.coalesce("_found", "_node")).drop("_found")


def undecided(members: DataFrame, key: str) -> DataFrame:
    """The rows of ``members`` whose list, by ``key``, holds several components."""
    spread = members.groupBy(key).agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"))
    return members.join(spread.filter("_low <> _high").select(key), key, "left_semi")


def without_leaders(members: DataFrame, key: str, order: Column) -> DataFrame:
    """The rows of ``undecided`` but the leaders of ``star_pairs`` by the same order: they
    have been compared with all of their list, so what is open is between the others."""
    lists = members.groupBy(key).agg(
        F.min("_label").alias("_low"),
        F.max("_label").alias("_high"),
        F.max(F.struct(order.alias("_order"), "_node")).alias("_lead"),
    )
    lists = lists.filter("_low <> _high").select(key, F.col("_lead._node").alias("_leader"))
    return members.join(lists, key).filter("_node <> _leader").drop("_leader")


def star_pairs(members: DataFrame, key: str, order: Column) -> DataFrame:
    """Each member of a list with the list's leader, the one of greatest ``order``, if
    their sizes allow a link and no component holds both. At most a pair a row."""
    leaders = members.groupBy(key).agg(
        F.max(F.struct(order.alias("_order"), "_node", "_n", "_label")).alias("_lead")
    )
    pairs = members.join(leaders, key).filter(F.col("_label") != F.col("_lead._label"))
    pairs = pairs.filter(near_sizes(F.col("_n"), F.col("_lead._n")))
    a, b = F.least("_node", F.col("_lead._node")), F.greatest("_node", F.col("_lead._node"))
    return pairs.groupBy(a.alias("_a"), b.alias("_b")).agg(F.count("*").alias("_overlap"))


def moved_labels(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """``labels`` after ``merged`` ``(_node, _label)`` has joined some of them."""
    onto = merged.select(F.col("_node").alias("_label"), F.col("_label").alias("_to"))
    moved = labels.join(onto, "_label", "left").select(
        "_node", F.coalesce("_to", "_label").alias("_label")
    )
    return moved.unionByName(merged.join(labels.select("_node"), "_node", "left_anti"))


def shingles_of(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``(_node, _label, _n, _token)``: the sets of ``members`` as rows."""
    own = sets.join(members.select("_node", "_label").distinct(), "_node")
    return own.select("_node", "_label", F.size("_set").alias("_n"), F.explode("_set").alias("_token"))


def rarest(own: DataFrame) -> DataFrame:
    """``(_token, _node, _n, _label, _probe)``: the rows of ``shingles_of`` by which
    members meet.

    With shingles ordered from rare to frequent, two linked sets share one among the
    first ``n - ceil(3n/4) + 1`` of the larger set and the first
    ``n - ceil(6n/7) + 1`` of the smaller one; ``_probe`` is true for those of the
    larger set's part only. Shingles of a single member come first and meet nobody.
    ``_after`` counts the shingles from this one on.
    """
    held = own.groupBy("_token").agg(F.count("*").alias("_held")).filter("_held > 1")
    ranked = own.join(held, "_token").groupBy("_node", "_label", "_n").agg(
        F.sort_array(F.collect_list(F.struct("_held", "_token"))).alias("_tokens")
    )
    n, alone = F.col("_n"), F.col("_n") - F.size("_tokens")
    large = n - F.ceil(n * SIMILARITY / 100) + 1 - alone
    small = n - F.ceil(n * (2 * SIMILARITY) / (100 + SIMILARITY)) + 1 - alone
    first = F.slice("_tokens", F.lit(1), F.greatest(large, F.lit(0)).cast("int"))
    many = F.size("_tokens").alias("_many")
    out = ranked.select("_node", "_label", "_n", small.alias("_small"), many, F.posexplode(first))
    out = out.withColumn("_probe", F.col("pos") >= F.col("_small"))
    after = F.col("_many") - F.col("pos")
    return out.select(
        F.col("col._token").alias("_token"), "_node", "_n", "_label", "_probe", after.alias("_after")
    )


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``documents``.

    Shingles are five words, with A-Z in lower case; a text of fewer words is one
    shingle. Documents are linked where the shingle sets have a Jaccard similarity of
    3/4 or more; ``component_id`` is the least id reachable and ``kept`` marks its rows.

    Texts without words, null ones included, are linked with nothing and kept. Rows
    without an id are counted but never stand for a group: their component is that of
    equal texts with an id, or null, and then they are kept. Ids may repeat, each row
    follows its own text. Other columns are ignored.
    """
    out = _near_duplicates(documents, id_col, text_col)
    return out.select(id_col, "n_shingles", "component_id", "kept")


def without_near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``documents`` without the rows that are not kept. Rows that agree in id and text
    are one document and stay or go together."""
    found = _near_duplicates(documents, id_col, text_col).filter(~F.col("kept"))
    gone = found.select(F.col(id_col).alias("_gone"), F.col("_hash").alias("_gone_hash"))
    same = documents[id_col].eqNullSafe(F.col("_gone"))
    same &= F.xxhash64(documents[text_col]) == F.col("_gone_hash")
    return documents.join(gone, same, "left_anti")


def with_duplicate_cluster(
    documents: DataFrame,
    cluster_col: str,
    words_col: str,
    keep: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The id and the columns ``keep`` of ``documents`` with the number of words of each text
    and one that near-duplicates have in common, a string. Texts are read, not moved.

    Texts without a component, such as those without words, share it with equal texts
    only; it is null for null texts.
    """
    rows = _near_duplicates(documents, id_col, text_col, keep)
    component = F.concat(F.lit("near "), F.col("component_id").cast("string"))
    component = F.when(F.col("n_shingles") > 0, component)
    equal = F.when(~F.col("_null"), F.concat(F.lit("equal "), F.col("_hash").cast("string")))
    cluster = F.coalesce(component, equal).alias(cluster_col)
    return rows.select(id_col, *keep, F.col("_words").alias(words_col), cluster)


def _near_duplicates(
    documents: DataFrame, id_col: str, text_col: str, keep: Sequence[str] = ()
) -> DataFrame:
    spark = documents.sparkSession
    own = shared_table(sketches(documents, id_col, text_col, keep), "sketches")
    nodes = own.filter("_node IS NOT NULL").groupBy("_node").agg(
        F.min(id_col).alias("_rep"),
        F.max("n_shingles").alias("_n"),
        F.first("_sketch").alias("_sketch"),
    )
    nodes = shared_table(nodes.filter("_rep IS NOT NULL"), "nodes")

    # Most keys have one row: counting beside the rows moves them once, without a join.
    held = F.count("*").over(Window.partitionBy("_key"))
    shared = key_rows(nodes).withColumn("_held", held).filter("_held > 1").drop("_held")
    members = shared_table(shared, "members")
    # Members with many shared keys are near the middle of their group: they lead.
    weight = members.groupBy("_node").agg(F.count("*").alias("_weight"))
    lists = members.join(weight, "_node").withColumn("_label", F.col("_node"))
    lists = shared_table(lists, "members")
    drop_tables(members)
    members = lists
    release_shuffles(spark)
    taking_part = members.select("_node").distinct().join(nodes.select("_node", "_rep"), "_node")
    sets = shared_table(full_sets(documents, taking_part, id_col, text_col), "sets")
    release_shuffles(spark)

    pairs = star_pairs(members, "_key", F.col("_weight"))
    for end in ("_a", "_b"):
        named = nodes.select(F.col("_node").alias(end), F.col("_sketch").alias("_sketch" + end))
        pairs = pairs.join(named, end)
    pairs = pairs.filter(estimate(F.col("_sketch_a"), F.col("_sketch_b")) >= LEAST_ESTIMATE)
    labels = components(confirmed(pairs.select("_a", "_b"), sets))
    release_shuffles(spark)

    open_lists = without_leaders(labelled(members.drop("_label"), labels), "_key", F.col("_weight"))
    open_lists = undecided(open_lists, "_key")
    shingles = shared_table(shingles_of(open_lists, sets), "shingles")
    drop_tables(members)
    tokens = shared_table(rarest(shingles), "tokens")
    drop_tables(shingles)
    star = star_pairs(undecided(tokens, "_token"), "_token", F.xxhash64("_node"))
    star = shared_table(contracted(confirmed(star.select("_a", "_b"), sets), labels), "links")
    now = moved_labels(labels, hooked(star))
    release_shuffles(spark)

    rest = undecided(labelled(tokens.drop("_label"), now), "_token")
    rest = shared_table(rest, "rest")
    renamed = [F.col(c).alias(c + "1") for c in ("_node", "_n", "_label", "_after")]
    one = rest.filter(~F.col("_probe")).select("_token", *renamed)
    pairs = rest.join(one, "_token").filter(F.col("_label") != F.col("_label1"))
    pairs = pairs.filter((F.col("_n") >= F.col("_n1")) & near_sizes(F.col("_n"), F.col("_n1")))
    # If this is the first shingle they share, no more than these are shared in all.
    most = F.least("_after", "_after1")
    pairs = pairs.filter(alike(F.col("_n"), F.col("_n1"), most))
    a, b = F.least("_node", "_node1"), F.greatest("_node", "_node1")
    pairs = pairs.select(a.alias("_a"), b.alias("_b")).distinct()
    last = contracted(confirmed(pairs, sets), labels)
    labels = moved_labels(labels, components(star.unionByName(last)))
    drop_tables(sets, tokens, rest, star)
    release_shuffles(spark)

    named = nodes.select("_node", "_rep")
    groups = labels.join(named, "_node")
    least = groups.groupBy("_label").agg(F.min("_rep").alias("_least"))
    linked = groups.join(least, "_label").select("_node", "_least")
    named = named.join(linked, "_node", "left").select(
        "_node", F.coalesce("_least", "_rep").alias("component_id")
    )
    out = own.drop("_sketch").join(named, "_node", "left")
    component = F.coalesce("component_id", F.col(id_col))
    out = out.withColumn("component_id", component)
    kept = F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull())
    return out.withColumn("kept", kept).drop("_node")
