import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import awkward_texts, documents, empty
from tokenizers import Tokenizer

from tidemark.llm import queries, repair
from tidemark.llm.common import read_table
from tidemark.llm.repair import (
    Encoder,
    _sorted_pairs,
    build_grammar,
    expand,
    pack_grammar,
    read_grammar,
    read_ids,
    read_token_files,
    write_token_files,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [3, 300, 60_000, 200_000])
def test_round_trip_and_random_access(top):
    rng = random.Random(top)
    words = [[rng.randrange(top) for _ in range(rng.randint(1, 6))] for _ in range(50)]
    docs = [sum((rng.choice(words) for _ in range(rng.randint(0, 60))), []) for _ in range(60)]
    docs += [[], [1] * 500, [1, 2] * 300, []]
    sizes = np.array([len(d) for d in docs])
    grammar = build_grammar(np.array(sum(docs, []), dtype=np.uint32), sizes)
    data = pack_grammar(grammar)
    assert len(grammar.symbols) < 0.7 * sizes.sum()
    back = read_grammar(data)
    assert expand(back, back.symbols).tolist() == sum(docs, [])
    for rule in range(len(back.left)):
        assert len(expand(back, np.array([back.terminals + rule]))) == back.lengths[rule]
    for i, doc in enumerate(docs):
        assert read_ids(data, i).tolist() == doc
        a, b = sorted(rng.choices(range(len(doc) + 3), k=2))
        assert read_ids(data, i, a, b).tolist() == doc[a:b]


def test_pairs_are_replaced_until_none_is_frequent():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 50_000, 900)
    shards = {
        "copies": (np.tile(one, 300), np.full(300, 900)),
        "run": (np.full(4096, 7), np.array([4096])),
        "many pairs": (np.tile(np.arange(50_000), 5), np.full(5, 50_000)),
        "ends": (np.tile([1, 2, 3], 40), np.full(40, 3)),
    }
    size = {}
    for name, (ids, sizes) in shards.items():
        grammar = build_grammar(ids.astype(np.uint32), sizes)
        size[name] = len(grammar.symbols)
        data = pack_grammar(grammar)
        back = read_grammar(data)
        assert (expand(back, back.symbols) == ids).all()
        last = np.zeros(len(back.symbols) + 1, dtype=bool)
        last[back.starts] = True
        pairs = [p for p, end in zip(zip(back.symbols, back.symbols[1:]), last[1:]) if not end]
        counts = {}
        before = None
        for pair in pairs:
            if pair[0] != pair[1] or before != pair:
                counts[pair] = counts.get(pair, 0) + 1
                before = pair
            else:
                before = None
        assert max(counts.values(), default=0) < 4
    assert size["copies"] == 300 and size["many pairs"] == 5 and size["ends"] == 40
    assert size["run"] <= 4


@pytest.mark.parametrize("bound", [40, 2**31])
def test_pairs_and_places_are_sorted_alike_in_one_number_or_two(bound):
    rng = np.random.default_rng(bound)
    first, second = rng.integers(0, 40, (2, 5000)).astype(np.int32)
    left_out = np.flatnonzero(rng.random(5000) < 0.1)
    for out in (left_out, left_out[:0]):
        order, edges = _sorted_pairs(first, second, out, bound)
        places = sorted(set(range(5000)) - set(out.tolist()), key=lambda i: (first[i], second[i], i))
        assert order.tolist() == places
        pairs = [(first[i], second[i]) for i in places]
        assert edges.tolist() == [i for i, pair in enumerate(pairs) if i == 0 or pairs[i - 1] != pair]


def test_new_pieces_are_encoded_in_a_row():
    encode = Encoder(PATH)
    rng = random.Random(11)
    parts = ["a", "B", "é", "ß", "日", "7", "٣", ".", ",", "'s", "'", "$", "x.y", "e\u0301", "\u200b", "\ufeff"]
    parts += [*"     \n\n\t\x1c\x85\xa0\u2028\u3000\u2009\x01\x00", "\r\n", "<|endoftext|>", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["", " ", "word. word, word.\nword .word", *(t or "" for t in awkward_texts())]
    library = Tokenizer.from_file(PATH)
    made = [ids.ids for ids in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        got = encode([text.encode() for text in texts])
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == made
    calls = []
    each = encode._each
    encode._each = lambda pieces: calls.extend(pieces) or each(pieces)
    encode.known.clear()
    words = [f"new{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    text = ". ".join(words) + " " + "é, ".join(words)
    assert np.frombuffer(encode([text.encode()])[0], "<u4").tolist() == library.encode(text).ids
    # Words go in a row, without the stops behind them.
    assert calls == [".", ","] and sum(b"new" in piece for piece in encode.known) == 2 * len(words) - 1
    # A vocabulary that has no tokens for some bytes: each piece is encoded by itself.
    encode.known.clear()
    encode.sizes = encode.sizes * 2
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encode([b"one two", b"two. three"])] == [
        library.encode(text).ids for text in ("one two", "two. three")
    ]


def test_rules_are_opened_once_where_that_is_less(monkeypatch):
    opened = []
    plain = repair._open
    monkeypatch.setattr(repair, "_open", lambda g, own, sizes: opened.append(len(own)) or plain(g, own, sizes))
    rng = np.random.default_rng(2)
    words = rng.integers(0, 50, (30, 3))
    ids = words[rng.integers(0, 30, 5000)].ravel()
    grammar = build_grammar(ids.astype(np.uint32), np.array([9000, 0, 6000]))
    assert (expand(grammar, grammar.symbols) == ids).all()
    assert opened == [len(grammar.lengths)] and opened[0] < len(grammar.symbols)
    assert (expand(grammar, grammar.symbols[:2]) == ids[: len(expand(grammar, grammar.symbols[:2]))]).all()


def test_shards_without_ids():
    for sizes in ([], [0], [0, 0]):
        grammar = read_grammar(pack_grammar(build_grammar(np.zeros(0, np.uint32), np.array(sizes, dtype=np.int64))))
        assert len(grammar.starts) == len(sizes) + 1 and not len(expand(grammar, grammar.symbols))


def expected(rows):
    model = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return sorted(out, key=str)


def test_files_hold_what_the_library_encodes(spark, folder):
    df = documents(spark).repartition(5)
    write_token_files(df, PATH, folder, shard_ids=2000)
    files = spark.read.parquet(folder)
    assert files.count() >= 5
    rows = [(i, t) for i, t in enumerate(awkward_texts())] + [(None, "a row without an id")]
    assert sorted((tuple(r) for r in read_token_files(files).collect()), key=str) == expected(rows)


def test_repeated_rows_and_empty_tables(spark, folder):
    write_token_files(documents(spark, ["b c", None], copies=2), PATH, folder)
    got = sorted((tuple(r) for r in read_token_files(spark.read.parquet(folder)).collect()), key=str)
    assert got == expected([(0, "b c"), (1, None)] * 2 + [(None, "a row without an id")])
    write_token_files(empty(documents(spark)), PATH, folder + "-none")
    assert read_token_files(spark.read.parquet(folder + "-none")).count() == 0


def test_query_equals_the_library(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, sf_dir, "documents").collect()]
    got = sorted((tuple(r) for r in queries.op2_token_files(spark, sf_dir).collect()), key=str)
    assert got == expected(rows)
