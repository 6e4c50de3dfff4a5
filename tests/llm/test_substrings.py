import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward_texts, documents, empty

from tidemark.llm import queries, substrings
from tidemark.llm.common import read_table
from tidemark.llm.substrings import repeated_places, whole_groups, without_repeats


def plain(texts):
    seen = {}
    texts = [t or b"" for t in texts]
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=np.int64)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200 if i + 200 <= len(t) else len(t)] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        kept = bytes(b for b, g in zip(t, gone.tolist()) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def mixture(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(size)) for size in (30, 45, 60, 150, 400)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            low = rng.randrange(len(passage) // 2)
            parts.insert(rng.randrange(len(parts)), passage[low : low + rng.randint(150, 1500)])
        texts.append("".join(parts))
    return [*texts, texts[0], texts[0], "ab" * 300, "x" * 199, "x" * 200, "y" * 201, None, ""]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [False, True])
def test_equals_all_strings(spark, seed, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(substrings, "CHUNK", 700)
    if seed == 3:
        monkeypatch.setattr(substrings, "PIECE", 300)
    texts = mixture(seed)
    got = {r["doc_id"]: tuple(r)[1:5] for r in without_repeats(documents(spark, texts)).collect()}
    expected = plain([None if t is None else t.encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == expected
    assert sum(e[1] for e in expected) > 3000


def test_awkward_documents_and_repeated_rows(spark):
    texts = [t for t in awkward_texts() if t is None or len(t) < 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "same row " * 40)] * 2 + [(None, "n " * 150)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r)[:5] for r in without_repeats(df).collect()), key=str)
    made = plain([None if t is None else t.encode() for _, t in rows])
    assert got == sorted(((i, *m) for (i, _), m in zip(rows, made)), key=str)
    assert without_repeats(empty(documents(spark))).count() == 0


def test_places_equal_brute_force():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[2000:2400] = data[100:500]
    ends = np.repeat([1000, 2300, 3000], [1000, 1300, 700])
    for window in (8, 20, 200):
        keys = {}
        for i in range(3000):
            if ends[i] - i >= window:
                keys.setdefault(data[i : i + window].tobytes(), []).append(i)
        expected = sorted(i for own in keys.values() if len(own) > 1 for i in own)
        assert repeated_places(data, ends, window).tolist() == expected


def test_a_sort_takes_little_memory():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 500_000).astype(np.uint8)
    data[300_000:400_000] = data[:100_000]
    ends = np.full(len(data), len(data), dtype=np.int32)
    tracemalloc.start()
    found = repeated_places(data, ends)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 2 * (100_000 - 199)
    assert most < 60 * len(data)


def test_groups_are_sorted_together_up_to_a_limit():
    rng = random.Random(5)
    groups = sorted(rng.choice(range(60)) for _ in range(400)) + [60] * 100
    rows = [(h, bytes(rng.randint(1, 30))) for h in groups]
    fields = pa.schema({"h": pa.int64(), "bytes": pa.binary()})
    cuts = [0, 0, 7, 20, 21, 250, 460, 500]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), fields)], schema=fields)
        if part
        else pa.RecordBatch.from_pylist([], fields)
        for part in (rows[a:b] for a, b in zip(cuts, cuts[1:]))
    ]
    runs = [pa.Table.from_batches(own).to_pylist() for own in whole_groups(iter(batches), 300)]
    assert [tuple(row.values()) for own in runs for row in own] == rows
    held = [{row["h"] for row in own} for own in runs]
    assert sum(map(len, held)) == len(set(groups))
    sizes = [sum(len(row["bytes"]) for row in own) for own in runs]
    assert all(size <= 300 or len(own) == 1 for size, own in zip(sizes, held))
    assert len(runs) < len(set(groups)) and max(sizes) > 300
    assert list(whole_groups(iter([]), 300)) == []


def test_query_equals_all_strings(spark, sf_dir):
    rows = read_table(spark, sf_dir, "documents").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op7_repeated_substrings(spark, sf_dir).collect()}
    expected = plain([(r["text"] or "").encode() for r in rows])
    assert [got[r["doc_id"]] for r in rows] == expected
