"""Spelling variants by k-d trees over letter counts (operator 11).

One edit changes the counts of a word's letters by at most two in sum: a replaced letter
takes one away and adds another, an inserted or deleted one changes one count by one. So
the words near a given one lie in a small ball around its counts, among the words of its
own length and of the next one.

Words of one length are a forest's tree: its upper part is built level by level from counts
over all words and cuts space into cells, each with its words in one task. A word visits
the cells whose box its ball touches; there a k-d tree with a tight box for each node finds
the points in the ball, and the order of the letters decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_table, text_blocks

LEAST_LETTERS = 6
LEAST_USES = 5
FORM_FACTOR = 5
DELETION_CYCLE = 199
# Words of a cell, which one task holds at a time.
CELL = 4096
LEAF = 32
# The letters, each a dimension: a-z and U+00C0 to U+00FF, all of them in Latin-1.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # the same in UTF-8
_DIMENSION = np.zeros(256, dtype=np.int64)
_DIMENSION[LETTERS] = np.arange(len(LETTERS))
_HELD_WORDS = 200_000
_PAIRS = 50_000
# Counts of a letter from here on are one for the upper part of a tree.
_VALUES = 16


def _spelled(run: bytes, seed: int) -> bytes:
    """The run, less a letter where the contract's checksum asks for it."""
    check = zlib.crc32(run, seed)
    if check % DELETION_CYCLE:
        return run
    letters = run.decode()
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)``: the words and how often they occur, over all whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[bytes] = Counter()
        for batch in batches:
            for part, texts in text_blocks(batch, 1):
                for name, text in zip(part.column(0).to_pylist(), texts):
                    seed = zlib.crc32(f"{name or ''}:".encode())
                    for word, times in Counter(_RUN.findall((text or b"").lower())).items():
                        if len(word) >= LEAST_LETTERS:
                            totals[_spelled(word, seed)] += times
                if len(totals) >= _HELD_WORDS:
                    yield _counted(totals)
                    totals = Counter()
        if totals:
            yield _counted(totals)

    source = documents.select(documents[id_col].cast("string"), documents[text_col])
    made = source.mapInArrow(run, "word string, n bigint")
    made = made.filter(F.length("word") >= LEAST_LETTERS)
    return made.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_USES)


def _counted(totals: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(totals), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(totals.values()), pa.int64())], ["word", "n"])


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of counts for each Latin-1 word, a column for each letter."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = _DIMENSION[np.frombuffer(b"".join(words), dtype=np.uint8)]
    at = np.repeat(np.arange(len(words)), sizes) * len(LETTERS) + letters
    counts = np.bincount(at, minlength=len(words) * len(LETTERS)).reshape(len(words), -1)
    return counts.astype(np.int32)


def in_reach(
    lo: np.ndarray, hi: np.ndarray, left: np.ndarray, right: np.ndarray, root: int, queries: np.ndarray, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(query, leaf)`` for all leaves whose box is within ``reach`` of a query's row.

    A node is a box ``lo`` to ``hi``; leaves have no ``left``. Boxes out of reach are pruned
    with all below them.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_pairs = [(np.arange(len(queries)), np.full(len(queries), root, dtype=np.int64))]
    while open_pairs:
        row, node = open_pairs.pop()
        if len(row) > _PAIRS:
            middle = len(row) // 2
            open_pairs += [(row[:middle], node[:middle]), (row[middle:], node[middle:])]
            continue
        q = queries[row]
        off = (np.maximum(lo[node] - q, 0) + np.maximum(q - hi[node], 0)).sum(axis=1)
        row, node = row[off <= reach], node[off <= reach]
        end = left[node] < 0
        if end.any():
            found.append((row[end], node[end]))
        row, node = row[~end], node[~end]
        if len(row):
            open_pairs.append((np.concatenate([row, row]), np.concatenate([left[node], right[node]])))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])


@dataclass
class Forest:
    """The upper parts of the trees, one for each length of words."""

    roots: dict[int, int] = field(default_factory=dict)
    lo: list[np.ndarray] = field(default_factory=list)
    hi: list[np.ndarray] = field(default_factory=list)
    letter: list[int] = field(default_factory=list)
    limit: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    # Words of equal counts cannot be told apart by a tree: such a cell has several parts.
    parts: list[int] = field(default_factory=list)

    def add(self, lo: np.ndarray, hi: np.ndarray) -> int:
        for column, value in zip(
            (self.lo, self.hi, self.letter, self.limit, self.left, self.right, self.parts),
            (lo, hi, 0, 0, -1, -1, 1),
        ):
            column.append(value)
        return len(self.lo) - 1

    def split(self, node: int, letter: int, limit: int) -> tuple[int, int]:
        """Words with at most ``limit`` of the letter go left."""
        hi, lo = self.hi[node].copy(), self.lo[node].copy()
        hi[letter], lo[letter] = limit, limit + 1
        self.letter[node], self.limit[node] = letter, limit
        self.left[node], self.right[node] = self.add(self.lo[node], hi), self.add(lo, self.hi[node])
        return self.left[node], self.right[node]

    def arrays(self) -> dict:
        kinds = {"lo": np.int32, "hi": np.int32}
        names = ("lo", "hi", "letter", "limit", "left", "right", "parts")
        made = {n: np.array(getattr(self, n), dtype=kinds.get(n, np.int64)) for n in names}
        return made | {"roots": dict(self.roots)}


def cell_of(forest: dict, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The leaf of the forest that each word's counts lie in."""
    node = np.array([forest["roots"][s] for s in sizes.tolist()], dtype=np.int64)
    while True:
        inner = np.flatnonzero(forest["left"][node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        over = counts[inner, forest["letter"][at]] > forest["limit"][at]
        node[inner] = np.where(over, forest["right"][at], forest["left"][at])


def _latin(column: pa.Array) -> list[bytes]:
    return [word.encode("latin-1") for word in column.to_pylist()]


def _lengths(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def best_splits(words: DataFrame, forest: dict, open_cells: set[int]) -> list:
    """For each open cell the letter and limit that halve it best, and the two sizes.

    Tasks count words by cell, letter and value; the counts of a cell meet in one task,
    which returns a row. A cell that no letter splits has ``left_n`` 0.
    """
    shape = (len(LETTERS), _VALUES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            own = _latin(batch["word"])
            counts = letter_counts(own)
            cells = cell_of(forest, _lengths(own), counts)
            for cell in open_cells.intersection(cells.tolist()):
                values = np.minimum(counts[cells == cell], _VALUES - 1)
                at = (np.arange(shape[0]) * _VALUES + values).ravel()
                made = np.bincount(at, minlength=shape[0] * _VALUES)
                held[cell] = held[cell] + made if cell in held else made
        yield _table({"_cell": (list(held), pa.int64()), "_data": ([zlib.compress(h.tobytes(), 1) for h in held.values()], pa.binary())})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, data in zip(batch["_cell"].to_pylist(), batch["_data"].to_pylist()):
                made = np.frombuffer(zlib.decompress(data), dtype=np.int64)
                held[cell] = held[cell] + made if cell in held else made
        rows = []
        for cell, made in held.items():
            below = np.cumsum(made.reshape(shape), axis=1)[:, :-1]
            total = int(made[:_VALUES].sum())
            letter, limit = divmod(int(np.minimum(below, total - below).argmax()), _VALUES - 1)
            low = int(below[letter, limit])
            fine = 0 < low < total
            rows.append((cell, letter, limit, low if fine else 0, total - low if fine else total))
        names = ("cell", "letter", "limit", "left_n", "right_n")
        yield _table({name: ([r[i] for r in rows], pa.int64()) for i, name in enumerate(names)})

    made = words.select("word").mapInArrow(count, "_cell bigint, _data binary")
    fields = "cell bigint, letter bigint, limit bigint, left_n bigint, right_n bigint"
    return made.repartition("_cell").mapInArrow(choose, fields).collect()


def _table(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, kind) for k, (v, kind) in columns.items()})


def forest_of(words: DataFrame) -> dict:
    """Trees whose cells hold ``CELL`` words at most, from all words, a pass a level.

    The driver gets a row for each length and each cell of more than ``CELL`` words.
    """
    forest, open_cells = Forest(), {}
    everything = np.full(len(LETTERS), np.iinfo(np.int32).max // 2, dtype=np.int32)
    for row in words.groupBy(F.length("word").alias("size")).count().collect():
        root = forest.add(np.zeros(len(LETTERS), dtype=np.int32), everything)
        forest.roots[row["size"]] = root
        if row["count"] > CELL:
            open_cells[root] = row["count"]
    while open_cells:
        found = best_splits(words, forest.arrays(), set(open_cells))
        open_cells = {}
        for row in found:
            if not row["left_n"]:
                forest.parts[row["cell"]] = -(-row["right_n"] // CELL)
                continue
            halves = forest.split(row["cell"], row["letter"], row["limit"])
            sizes = zip(halves, (row["left_n"], row["right_n"]))
            open_cells |= {node: size for node, size in sizes if size > CELL}
    return forest.arrays()


def placed(words: DataFrame, forest: dict) -> DataFrame:
    """``(_cell, _part, _role, word, n)``: each word in its own cell (role 0) and as a
    query (role 1) where its ball reaches, among words of its length and of one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = [forest[name] for name in ("lo", "hi", "left", "right")]
        for batch in batches:
            own = _latin(batch["word"])
            sizes, counts = _lengths(own), letter_counts(own)
            cells = cell_of(forest, sizes, counts)
            part = np.array([zlib.crc32(w) for w in own], dtype=np.int64) % forest["parts"][cells]
            yield _placed_rows(batch, np.arange(len(own)), cells, part, 0)
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                for longer, reach in ((0, 2), (1, 1)):
                    root = forest["roots"].get(size + longer)
                    if root is None:
                        continue
                    row, cell = in_reach(*boxes, root, counts[mine], reach)
                    many = forest["parts"][cell]
                    part = np.concatenate([np.arange(m) for m in many.tolist()] or [many])
                    yield _placed_rows(batch, np.repeat(mine[row], many), np.repeat(cell, many), part, 1)

    return words.mapInArrow(run, "_cell bigint, _part bigint, _role int, word string, n bigint")


def _placed_rows(batch, rows, cells, parts, role) -> pa.RecordBatch:
    taken = batch.select(["word", "n"]).take(pa.array(rows, pa.int64()))
    places = [pa.array(cells, pa.int64()), pa.array(parts, pa.int64()), pa.array(np.full(len(rows), role), pa.int32())]
    return pa.RecordBatch.from_arrays([*places, *taken.columns], ["_cell", "_part", "_role", "word", "n"])


class LetterTree:
    """A k-d tree over the letter counts of words of one length."""

    def __init__(self, words: list[bytes]):
        self.letters = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)
        counts = letter_counts(words)
        # Letters that all words have alike split nothing.
        self.used = np.flatnonzero(counts.min(axis=0) < counts.max(axis=0))
        self.alike = counts[0].copy()
        self.alike[self.used] = 0
        self.counts = counts[:, self.used]
        self.order = np.arange(len(words))
        self.lo, self.hi, self.left, self.right, self.span = [], [], [], [], []
        self._build(0, len(words))
        self.boxes = [np.array(x) for x in (self.lo, self.hi, self.left, self.right)]
        self.span = np.array(self.span)

    def _build(self, start: int, stop: int) -> int:
        own = self.counts[self.order[start:stop]]
        lo, hi = own.min(axis=0), own.max(axis=0)
        node = len(self.lo)
        self.lo.append(lo), self.hi.append(hi), self.left.append(-1), self.right.append(-1)
        self.span.append((start, stop))
        if stop - start > LEAF and (lo < hi).any():
            letter = int(own.var(axis=0).argmax())
            values = own[:, letter]
            limit = min(int(np.median(values)), int(values.max()) - 1)
            under = values <= limit
            self.order[start:stop] = np.concatenate([self.order[start:stop][under], self.order[start:stop][~under]])
            middle = start + int(under.sum())
            self.left[node] = self._build(start, middle)
            self.right[node] = self._build(middle, stop)
        return node

    def near(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(query, point)``: the words one edit away from queries of one length, which is
        that of the tree's words or one less."""
        letters = np.frombuffer(b"".join(queries), dtype=np.uint8).reshape(len(queries), -1)
        reach = 2 if letters.shape[1] == self.letters.shape[1] else 1
        counts = letter_counts(queries)
        apart = counts - self.alike
        apart[:, self.used] = 0
        apart = np.abs(apart).sum(axis=1)
        rows = np.flatnonzero(apart <= reach)
        counts = counts[:, self.used][rows]
        row, leaf = in_reach(*self.boxes, 0, counts, reach)
        start, stop = self.span[leaf].T if len(leaf) else (leaf, leaf)
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        ends = np.cumsum(stop - start)
        first = 0
        while first < len(leaf):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + _PAIRS)))
            some = slice(first, last)
            size = stop[some] - start[some]
            q = np.repeat(row[some], size)
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            p = self.order[np.repeat(start[some], size) + offset]
            off = np.abs(counts[q] - self.counts[p]).sum(axis=1) + apart[rows[q]]
            q, p = rows[q[off == reach]], p[off == reach]
            fine = one_edit(letters[q], self.letters[p])
            found.append((q[fine], p[fine]))
            first = last
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replaced letter or, where ``b`` has one more,
    by that one."""
    width = a.shape[1]
    if b.shape[1] == width:
        return (a != b).sum(axis=1) == 1
    ahead = np.cumprod(a == b[:, :width], axis=1).sum(axis=1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= width


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: each word with each one that is one edit away."""
    rows = placed(words, forest_of(words))
    rows = rows.repartition("_cell", "_part").sortWithinPartitions("_cell", "_part", "_role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, uses, tree = None, [], [], None
        for batch in batches:
            places = np.stack([batch[c].to_numpy() for c in ("_cell", "_part", "_role")])
            cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(start, stop - start)
                cell, _, role = places[:, start].tolist()
                key = tuple(places[:2, start].tolist())
                if role == 0:
                    if key != at:
                        at, held, uses, tree = key, [], [], None
                    held += _latin(part["word"])
                    uses += part["n"].to_pylist()
                elif key == at:
                    tree = tree or LetterTree(held)
                    yield from _near_rows(tree, held, uses, part)

    return rows.mapInArrow(run, "word string, n bigint, near string, near_n bigint")


def _near_rows(tree, held, uses, part) -> Iterator[pa.RecordBatch]:
    queries, times = _latin(part["word"]), part["n"].to_pylist()
    sizes = _lengths(queries)
    for size in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == size)
        q, p = tree.near([queries[i] for i in mine])
        one = [(queries[mine[i]], times[mine[i]]) for i in q.tolist()]
        two = [(held[i], uses[i]) for i in p.tolist()]
        pairs = list(zip(one, two))
        if size < tree.letters.shape[1]:  # asked for in one direction only
            pairs += zip(two, one)
        columns = list(zip(*[(a[0].decode("latin-1"), a[1], b[0].decode("latin-1"), b[1]) for a, b in pairs]))
        names = (("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64()))
        yield _table({name: (columns[i] if columns else [], kind) for i, (name, kind) in enumerate(names)})


def followed(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words with a form: the last one that forms lead to.

    A form occurs ``FORM_FACTOR`` times as often as its word, so chains are short and have no
    cycles; each round doubles the steps made.
    """
    roots = shared_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = roots.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = shared_table(moved, "roots")
        roots = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return roots


def spelling_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``documents``.

    Words are runs of letters with A-Z in lower case, some with a letter deleted as the
    contract has it, of at least ``LEAST_LETTERS`` letters and ``LEAST_USES`` occurrences.
    A null text has no runs and a null id counts as an empty one; repeated rows count again.
    Ties of forms go to the first word in code-point order. An empty table has no words.
    Other columns are ignored, whatever their names.
    """
    words = shared_table(word_counts(documents, id_col, text_col), "words")
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_less"), "near")).alias("_best")
    )
    rows = words.join(best, "word", "left")
    form_n = -F.col("_best._less")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(form_n >= FORM_FACTOR * F.col("n"), F.struct(F.col("_best.near").alias("form"), form_n.alias("n"))).alias("_form"),
    )
    rows = rows.select("word", "n", "n_near", F.col("_form.form").alias("form"), F.col("_form.n").alias("form_n"))
    rows = shared_table(rows, "forms")
    roots = followed(rows.filter("form IS NOT NULL"))
    out = rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
