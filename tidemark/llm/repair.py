"""Token ids in files compressed by Re-Pair grammars (operator 2).

A file row is a shard: whole documents one after another, as symbols that are token ids
or nonterminals. A rule replaces a frequent pair of symbols by a nonterminal; with the
length of every rule's expansion, any stretch of a document is found and decoded without
the rest.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_blocks, mix64, text_bytes
from tidemark.llm.token_counts import (
    ENCODE_BYTES,
    MEMO_CHARS,
    MEMO_PIECES,
    byte_batches,
    leading_space_pieces,
    load_tokenizer,
    pieces_of,
)
from tidemark.session import new_folder

SHARD_IDS = 1_000_000
LEAST_USES = 4  # a rule pays for its two symbols and its length from here on
MAGIC = b"TMR2"
# magic, bytes of a symbol and of a length, terminals, token ids in use, rules, documents, symbols
_HEAD = struct.Struct("<4sBBxxIIIII")


class Grammar(NamedTuple):
    terminals: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # of the rules' expansions
    starts: np.ndarray  # of each document among the symbols, and the end
    symbols: np.ndarray


def _runs(at: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs at the places ``at``: whether one equals the pair before and overlaps it,
    and the numbers of those that are second, fourth and so on in such a run."""
    same = np.zeros(len(at), dtype=bool)
    twins = np.flatnonzero(first == second)
    # Pairs of one symbol at neighbouring places are of the same symbol.
    again = np.zeros(len(twins), dtype=bool)
    again[1:] = at[twins[1:]] == at[twins[:-1]] + 1
    same[twins[again]] = True
    place = np.arange(len(twins))
    return same, twins[(place - np.maximum.accumulate(np.where(again, 0, place))) % 2 == 1]


def _sorted_pairs(
    first: np.ndarray, second: np.ndarray, left_out: np.ndarray, bound: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of symbols below ``bound`` in the order of the pairs, without those
    left out, and where each pair begins. Pair and place are sorted as one number if they
    fit into it."""
    width, spare = (bound - 1).bit_length(), len(first).bit_length()
    together = 2 * width + spare < 64
    keys = first.astype(np.int64)
    keys <<= width if together else 32
    keys |= second
    if together:
        keys <<= spare
        keys |= np.arange(len(first))
    if len(left_out):
        counted = np.ones(len(first), dtype=bool)
        counted[left_out] = False
        counted = np.flatnonzero(counted)
        keys = keys[counted]
    if together:
        keys.sort()
        order = keys & ((1 << spare) - 1)
        keys >>= spare
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        order = counted[order] if len(left_out) else order
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return order, np.flatnonzero(new)


def build_grammar(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST_USES) -> Grammar:
    """Replace frequent pairs round by round until none is found ``least`` times.

    In a round the pairs found ``least`` times get ranks by their counts, equal ones by a
    hash, as chains of rising ranks would be replaced one place a round; in a run of one
    symbol every second pair counts. A place is replaced if no overlapping pair has a
    better rank, so that replaced places never touch, and the best pair is replaced
    wherever it counts: each round goes forward. Pairs do not cross documents. A pair
    that was rare stays so until one of its places is next to a new symbol, so only the
    other places are counted again.
    """
    terminals = int(ids.max(initial=0)) + 1
    symbols = ids.astype(np.int64 if terminals + len(ids) >= 2**31 else np.int32)
    last = np.zeros(len(ids), dtype=bool)
    ends = np.cumsum(sizes)
    last[ends[sizes > 0] - 1] = True
    left, right, lengths = [], [], []
    size_of = np.ones(terminals, dtype=np.int64)
    live = ~last
    while live.any():
        base = len(size_of)
        at = np.flatnonzero(live)
        first, second = symbols[at], symbols[at + 1]
        same, odd = _runs(at, first, second)
        order, edges = _sorted_pairs(first, second, odd, base)
        counts = np.diff(edges, append=len(order))
        frequent = np.flatnonzero(counts >= least)
        if not len(frequent):
            break
        example = order[edges[frequent]]
        pairs = (first[example].astype(np.int64) << 32) | second[example]
        by_rank = np.lexsort((mix64(pairs), -counts[frequent]))
        pairs, none = pairs[by_rank], len(by_rank)
        rank_of = np.full(len(counts), none, dtype=np.int32)
        rank_of[frequent[by_rank]] = np.arange(none, dtype=np.int32)
        rank = np.empty(len(at), dtype=np.int32)
        rank[order] = np.repeat(rank_of, counts)
        rank[odd] = rank[odd - 1]
        here = np.full(len(symbols) + 2, none, dtype=np.int32)
        here[at + 1] = rank
        live[at[rank == none]] = False
        rank[odd] = none
        some = np.flatnonzero(rank < none)
        place, own = at[some], rank[some]
        chosen = ((own < here[place]) | same[some]) & (own <= here[place + 2])
        place, own = place[chosen], own[chosen]
        good = np.flatnonzero(np.bincount(own, minlength=none) >= least)
        name = np.full(none, -1, dtype=symbols.dtype)
        name[good] = base + np.arange(len(good))
        name = name[own]
        new = place[name >= 0]
        rules = pairs[good]
        left.append(rules >> 32)
        right.append(rules & 0xFFFFFFFF)
        size_of = np.concatenate([size_of, size_of[left[-1]] + size_of[right[-1]]])
        lengths.append(size_of[base:])
        symbols[new] = name[name >= 0]
        last[new] = last[new + 1]
        live[new] = True
        live[new[new > 0] - 1] = True
        keep = np.ones(len(symbols), dtype=bool)
        keep[new + 1] = False
        symbols, last, live = symbols[keep], last[keep], live[keep]
        live &= ~last
    none_yet = [np.zeros(0, dtype=np.int64)]
    per_document = np.zeros(len(sizes), dtype=np.int64)
    stops = np.flatnonzero(last) + 1
    per_document[sizes > 0] = np.diff(stops, prepend=0)
    starts = np.concatenate([[0], np.cumsum(per_document)])
    joined = [np.concatenate(x or none_yet) for x in (left, right, lengths)]
    return Grammar(terminals, *joined, starts, symbols)


def _narrow(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _wide(data: bytes, count: int, width: int, at: int) -> np.ndarray:
    out = np.zeros((count, 4), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, count * width, at).reshape(count, width)
    return out.view("<u4").ravel().astype(np.int64)


def _width(count: int) -> int:
    return 2 if count <= 2**16 else 3 if count <= 2**24 else 4


def pack_grammar(grammar: Grammar) -> bytes:
    """The file format: a head, the token ids in use and starts of documents in four bytes
    each, lengths of expansions, rules and symbols in as few as they need, all
    little-endian. A symbol is the place of a token id among those in use, or a rule
    counted on from there, so that most shards get by with two bytes."""
    used = np.zeros(grammar.terminals, dtype=bool)
    for own in (grammar.left, grammar.right, grammar.symbols):
        used[own[own < grammar.terminals]] = True
    table = np.flatnonzero(used)
    place = np.concatenate([np.cumsum(used) - 1, len(table) + np.arange(len(grammar.left))])
    width = _width(len(place) - grammar.terminals + len(table))
    long = _width(int(grammar.lengths.max(initial=0)) + 1)
    head = _HEAD.pack(
        MAGIC,
        width,
        long,
        grammar.terminals,
        len(table),
        len(grammar.left),
        len(grammar.starts) - 1,
        len(grammar.symbols),
    )
    wide = [_narrow(table, 4), _narrow(grammar.starts, 4), _narrow(grammar.lengths, long)]
    return head + b"".join(
        wide + [_narrow(place[own], width) for own in (grammar.left, grammar.right, grammar.symbols)]
    )


def read_grammar(data: bytes) -> Grammar:
    magic, width, long, terminals, used, rules, documents, symbols = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    at = _HEAD.size
    arrays = []
    for count, size in (
        (used, 4), (documents + 1, 4), (rules, long), (rules, width), (rules, width), (symbols, width)
    ):
        arrays.append(_wide(data, count, size, at))
        at += count * size
    table, starts, lengths = arrays[:3]
    names = np.concatenate([table, terminals + np.arange(rules)])
    left, right, sequence = (names[own] for own in arrays[3:])
    return Grammar(terminals, left, right, lengths, starts, sequence)


def expand(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The token ids of symbols. Where those of all rules are fewer, each rule is opened
    once and copied to its places."""
    sizes = symbol_lengths(grammar, symbols)
    total = int(sizes.sum())
    if grammar.terminals + int(grammar.lengths.sum()) >= total:
        return _open(grammar, symbols.astype(np.int64), sizes)
    rules = grammar.terminals + np.arange(len(grammar.lengths))
    table = np.concatenate([np.arange(grammar.terminals), _open(grammar, rules, grammar.lengths)])
    first = np.arange(grammar.terminals + len(rules))
    first[grammar.terminals :] = grammar.terminals + np.cumsum(grammar.lengths) - grammar.lengths
    at = np.repeat(first[symbols] - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(total)
    return table[at]


def _open(grammar: Grammar, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token ids of symbols, each nonterminal opened at its place."""
    place = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), dtype=np.int64)
    while len(symbols):
        nested = symbols >= grammar.terminals
        out[place[~nested]] = symbols[~nested]
        rule, place = symbols[nested] - grammar.terminals, place[nested]
        first, second = grammar.left[rule], grammar.right[rule]
        place = np.concatenate([place, place + symbol_lengths(grammar, first)])
        symbols = np.concatenate([first, second])
    return out


def symbol_lengths(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    rule = symbols - grammar.terminals
    sizes = np.concatenate([grammar.lengths, [1]])
    return sizes[np.where(rule >= 0, rule, len(grammar.lengths))]


def read_ids(data: bytes, document: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a document of a shard; only the symbols that hold
    them are opened."""
    grammar = read_grammar(data)
    symbols = grammar.symbols[grammar.starts[document] : grammar.starts[document + 1]]
    ends = np.cumsum(symbol_lengths(grammar, symbols))
    total = int(ends[-1]) if len(ends) else 0
    stop = total if stop is None else min(stop, total)
    if start >= stop:
        return np.zeros(0, dtype=np.int64)
    first, last = np.searchsorted(ends, (start, stop - 1), side="right")
    before = int(ends[first - 1]) if first else 0
    return expand(grammar, symbols[first : last + 1])[start - before : stop - before]


# White space beyond ASCII, in UTF-8.
_WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))]
_WIDE_SPACES += [chr(c).encode() for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_LEAD = np.isin(np.arange(256), [own[0] for own in _WIDE_SPACES])
_SPACE = np.array([chr(byte).isspace() and byte < 128 for byte in range(256)])
_LETTER = np.array([chr(byte).isalpha() and byte < 128 for byte in range(256)])
_STOPS = '.,;:!?"$%&*#)'
_STOP = np.isin(np.arange(256), list(_STOPS.encode()))
# The characters by which byte-level tokenizers write bytes: printable ones stand for
# themselves, the others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS_OF_BYTES = np.arange(256, dtype="<u2")
_LETTERS_OF_BYTES[np.setdiff1d(np.arange(256), _PRINTABLE)] = 256 + np.arange(256 - len(_PRINTABLE))


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are white space, in either view, Python's or the tokenizers'."""
    space = _SPACE[data]
    leads = np.flatnonzero(_WIDE_LEAD[data])
    if len(leads):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        for own in _WIDE_SPACES:
            hits = leads[np.all([padded[leads + i] == byte for i, byte in enumerate(own)], axis=0)]
            for i in range(len(own)):
                space[hits + i] = True
    return space


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to Latin letters up to U+017F."""
    inside = _LETTER[data]
    lead = (data >= 0xC3) & (data <= 0xC5)
    if lead.any():
        at = np.flatnonzero(lead[:-1])
        at = at[~((data[at] == 0xC3) & ((data[at + 1] == 0x97) | (data[at + 1] == 0xB7)))]
        inside[at] = inside[at + 1] = True
    return inside


def byte_level_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where to cut texts, one after another in ``data``, so that a byte-level tokenizer
    gives the ids of the pieces: at their starts, before a single blank and around a
    single line end between other characters, and between a Latin letter and one of
    ``_STOPS``."""
    space = _spaces(data)
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[starts] = True
    begins[-1] = True
    cut = begins.copy()
    alone = (data == 32) | (data == 10)
    alone[1:] &= ~space[:-1]
    alone[:-1] &= ~space[1:]
    alone &= ~(begins[:-1] | begins[1:])
    cut[:-1] |= alone
    cut[1:] |= alone & (data == 10)
    cut[1:-1] |= _word_bytes(data)[:-1] & _STOP[data[1:]]
    return np.flatnonzero(cut)


class Encoder:
    """Token ids of texts as little-endian 32-bit integers, by a tokenizers file.

    Texts are cut where it is safe; pieces met before are looked up, once a block. New
    pieces for a byte-level tokenizer that are one word, whatever the version of Unicode,
    go to the library's model in a row, the others through all of its steps. The bytes
    that each token stands for tell where a word ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.model = load_tokenizer(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.cut = pieces_of(path)
        self.known: dict = {}
        added = {n: token.content for n, token in self.model.get_added_tokens_decoder().items()}
        names = {n: name for name, n in self.model.get_vocab().items()} | added
        # A byte-level token has a character a byte; an added one is matched as it is.
        self.sizes = np.zeros(max(names, default=0) + 1, dtype=np.int64)
        for n, name in names.items():
            self.sizes[n] = len(name.encode() if n in added else name)
        self.byte_level = self.cut is leading_space_pieces
        inside = rf"\s|[^\W\d_][{re.escape(_STOPS)}]|^[^\W\d_]+$"
        if any(re.search(inside, content) for content in added.values()):
            self.byte_level = False
        self.words = Tokenizer(self.model.model)
        self.words.pre_tokenizer = CharDelimiterSplit("\n")

    def _each(self, pieces: list[str]) -> list[bytes]:
        return [
            np.array(ids.ids, dtype="<u4").tobytes()
            for batch in byte_batches(pieces)
            for ids in self.model.encode_batch_fast(batch, add_special_tokens=False)
        ]

    def _in_a_row(self, data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Ids of words, one after another in ``data``."""
        row = np.full(len(data) + len(sizes), 10, dtype="<u2")
        row[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = _LETTERS_OF_BYTES[data]
        made = self.words.encode_batch_fast([row.tobytes().decode("utf-16-le")], add_special_tokens=False)
        ids = np.array(made[0].ids, dtype="<u4")
        stops = np.cumsum(sizes)
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        last = np.minimum(np.searchsorted(ends, stops), len(ids))
        # A byte that the vocabulary lacks has no token: then there is no telling.
        if ends[-1] != stops[-1] or (ends[last] != stops).any():
            return self._each([data[a:b].tobytes().decode() for a, b in zip(stops - sizes, stops)])
        tokens, edges = ids.tobytes(), [0, *(4 * last).tolist()]
        return [tokens[a:b] for a, b in zip(edges, edges[1:])]

    def _learn(self, new: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        data = np.frombuffer(b"".join(new), np.uint8)
        stops = np.cumsum(sizes)
        starts = stops - sizes
        letters = np.concatenate([[0], np.cumsum(_word_bytes(data))])
        letters = letters[stops] - letters[starts]
        word = (letters + (data[starts] == 32) == sizes) & (letters > 0)
        others = [new[i].decode() for i in np.flatnonzero(~word).tolist()]
        data, sizes = data[np.repeat(word, sizes)], sizes[word]
        stops = np.cumsum(sizes)
        made: list[bytes] = []
        for block in byte_blocks(sizes.tolist(), ENCODE_BYTES):
            own = data[stops[block.start] - sizes[block.start] : stops[block.stop - 1]]
            made += self._in_a_row(own, sizes[block])
        if not others:
            return made
        row, each = iter(made), iter(self._each(others))
        return [next(row) if own else next(each) for own in word.tolist()]

    def _bytes(self, texts: list[bytes]) -> list[bytes]:
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        if not sizes.any():
            return [b""] * len(texts)
        ends = np.cumsum(sizes)
        raw = b"".join(texts)
        cuts = byte_level_cuts(np.frombuffer(raw, np.uint8), ends - sizes)
        offsets = pa.py_buffer(cuts.astype(np.int64))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(raw)]
        ).dictionary_encode()
        number = pieces.indices.to_numpy()
        _, offsets, body = pieces.dictionary.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(pieces.dictionary) + 1).tolist()
        body = body.to_pybytes()
        distinct = [body[a:b] for a, b in zip(offsets, offsets[1:])]
        found = list(map(self.known.get, distinct))
        places = [i for i, ids in enumerate(found) if ids is None]
        if places:
            new = [distinct[i] for i in places]
            if len(self.known) + len(new) > MEMO_PIECES:
                self.known.clear()
            for i, piece, ids in zip(places, new, self._learn(new)):
                found[i] = ids
                if len(piece) <= MEMO_CHARS:
                    self.known[piece] = ids
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(counts) - counts
        tokens = np.frombuffer(b"".join(found), dtype="<u4")
        own = counts[number]
        stops = np.cumsum(own)
        at = np.repeat(first[number] - (stops - own), own)
        at += np.arange(len(at))
        data = tokens[at].tobytes()
        edges = 4 * np.concatenate([[0], stops])[np.searchsorted(cuts, np.concatenate([[0], ends]))]
        return [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if self.byte_level:
            return self._bytes(texts)
        known = self.known
        cut = [self.cut(text.decode()) for text in texts]
        new = list(set().union(*cut).difference(known))
        known.update(zip(new, self._each(new)))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > MEMO_CHARS:
                del known[piece]
        if len(known) > MEMO_PIECES:
            known.clear()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_token_files(
    documents: DataFrame,
    path: str,
    folder: str,
    end_id: int | None = 2,
    shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``documents`` in ascending id order and write them to ``folder``.

    The folder is a table with a row per shard: ``part`` and ``shard`` order them,
    ``ids`` are the document ids, ``n_ids`` the token ids in it, ``data`` the shard in
    the format of ``pack_grammar``. Spark commits its files, so a lost task leaves
    nothing behind. A null text is empty: its document has the end id alone. Null ids
    come first; rows of one id are ordered by text. Other columns are not written.
    """
    rows = documents.select(documents[id_col].alias("_id"), documents[text_col].alias("_text"))
    rows = rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    id_type = rows.schema["_id"].dataType.simpleString()
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        part = TaskContext.get().partitionId()
        ids: list = []
        held: list[bytes] = []
        size = shard = 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(own) // 4 for own in held], dtype=np.int64)
            tokens = np.frombuffer(b"".join(held), dtype="<u4")
            data = pack_grammar(build_grammar(tokens, counts))
            names = pa.array([ids], pa.list_(id_arrow))
            columns = {"part": [part], "shard": [shard], "n_ids": [len(tokens)]}
            return pa.RecordBatch.from_pydict(columns | {"ids": names, "data": [data]})

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            names, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            texts = [text or b"" for text in texts]
            for block in byte_blocks(map(len, texts)):
                for name, tokens in zip(names[block], encode(texts[block])):
                    ids.append(name)
                    held.append(tokens + end)
                    size += len(held[-1]) // 4
                    if size >= shard_ids:
                        yield flush()
                        ids, held, size, shard = [], [], 0, shard + 1
        if ids:
            yield flush()

    fields = f"part bigint, shard bigint, n_ids bigint, ids array<{id_type}>, data binary"
    rows.mapInArrow(run, fields).write.parquet(folder)


def read_token_files(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` per document from the table of shards.

    ``start`` counts the ids of all documents before it. The sums before a part and
    before a shard of it come from two small windows over the shards' sizes.
    """
    parts = df.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = df.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_in"))
    starts = shards.join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_in")).alias("start"))
    placed = df.join(starts, ["part", "shard"]).select("ids", "data", "start")
    id_type = df.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, data, start in zip(*(batch.column(i) for i in range(3))):
                grammar = read_grammar(data.as_py())
                tokens = expand(grammar, grammar.symbols).astype("<u4")
                sizes = symbol_lengths(grammar, grammar.symbols)
                ends = np.concatenate([[0], np.cumsum(sizes)])[grammar.starts]
                raw = memoryview(tokens.tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: names.values,
                        "start": start.as_py() + ends[:-1],
                        "n_tokens": np.diff(ends),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    fields = f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.mapInArrow(run, fields)


def token_files(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``documents`` to files in the shared folder and read them back."""
    spark = documents.sparkSession
    folder = new_folder(spark, "token-ids")
    write_token_files(documents, path, folder, id_col=id_col, text_col=text_col)
    return read_token_files(spark.read.parquet(folder), id_col)
