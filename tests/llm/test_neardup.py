import random

import numpy as np
import pytest
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.common import read_table
from tidemark.llm.neardup import (
    components,
    estimate,
    key_rows,
    near_duplicates,
    run_keys,
    shingle_sets,
    undecided,
    with_duplicate_cluster,
    without_leaders,
    word_hashes,
)


def plain(texts):
    """Component by row number, from all pairs of word tuples."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        width = min(5, len(words)) or 1
        sets.append({(len(words) < 5, *words[i : i + width]) for i in range(len(words) - width + 1)})
    least = list(range(len(texts)))
    again = True
    while again:
        again = False
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    low = min(least[i], least[j])
                    again |= least[i] != low or least[j] != low
                    least[i] = least[j] = low
    return [(len(s), low) for s, low in zip(sets, least)]


def mutated(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(seed):
    """Groups around originals, chains, short texts and one shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for size, copies in ((150, 40), (60, 15), (12, 10), (8, 6), (6, 6), (5, 3), (3, 3)):
        origin = [rng.choice(vocabulary) for _ in range(size)]
        texts += [mutated(rng, origin, rng.randint(0, max(1, size // 12))) for _ in range(copies)]
    step = [rng.choice(vocabulary) for _ in range(100)]
    for i in range(12):
        texts.append(" ".join(step))
        step[i * 8] = f"step{i}"
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(60)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_all_pairs(spark, seed):
    texts = family(seed) + awkward_texts()
    got = {r["doc_id"]: r for r in near_duplicates(documents(spark, texts)).collect()}
    for i, (n, low) in enumerate(plain(texts)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, low, low == i)
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(3, "a b c"), (3, "a b c"), (5, "A B C"), (None, "a b c"), (None, "x"), (7, "x y"), (7, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(str, (tuple(r) for r in near_duplicates(df).collect())))
    assert got == sorted(
        map(str, [(3, 1, 3, True), (3, 1, 3, True), (5, 1, 3, False), (None, 1, 3, False)]
            + [(None, 1, None, True), (7, 1, 7, True), (7, 1, 7, True)])
    )
    assert near_duplicates(empty(documents(spark))).count() == 0


def test_linked_sets_share_a_key(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        union = [rng.getrandbits(60) for _ in range(rng.randint(4, 90))]
        drop = rng.sample(range(len(union)), len(union) // 4)
        side = {k: rng.random() < 0.5 for k in drop}
        a = sorted(v for k, v in enumerate(union) if not side.get(k, False))
        b = sorted(v for k, v in enumerate(union) if side.get(k, True))
        rows.append((i, a, b))
    df = spark.createDataFrame(rows, "i int, a array<bigint>, b array<bigint>")
    keys = [run_keys(F.slice(c, 1, 64), F.size(c)) for c in "ab"]
    assert df.filter(~F.arrays_overlap(*keys)).count() == 0
    for row in df.select("a", "b", estimate(F.slice("a", 1, 64), F.slice("b", 1, 64)).alias("e")).collect():
        assert row["e"] >= 0.42


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "_a int, _b int")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}


def test_query_equals_all_pairs(spark, sf_dir):
    rows = read_table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in queries.op9_near_duplicates(spark, sf_dir).collect()}
    sets = shingle_sets([(r["text"] or "").encode() for r in rows])
    least = list(range(len(rows)))
    for _ in range(3):
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j], assume_unique=True))
                if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                    least[i] = least[j] = min(least[i], least[j])
    for i, row in enumerate(rows):
        assert got[row["doc_id"]]["component_id"] == rows[least[i]]["doc_id"]


def test_words_of_many_texts_are_hashed_at_once():
    rng = random.Random(4)
    pieces = ["a", "B", "b", "\u00e9", " ", "  ", "\n", "\t", "\x0b", "\r", "\x1c", "\x85", "\xa0", "word" * 20, "\0"]
    texts = [None, b"", b" \xff\xfe ", b"x" * 64, b"x" * 65]
    texts += ["".join(rng.choices(pieces, k=rng.choice([1, 3, 30]))).encode() for _ in range(300)]
    words = [(text or b"").lower().split() for text in texts]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [len(own) for own in words]
    flat = sum(words, [])
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_rows_of_keys_are_the_runs(spark):
    rows = [(i, n, list(range(i, i + n))) for i, n in enumerate([1, 2, 3, 8, 9, 64])]
    df = spark.createDataFrame(rows, "_node int, _n bigint, _sketch array<bigint>")
    plain = df.select("_node", F.explode(run_keys(F.col("_sketch"), F.col("_n"))))
    got = key_rows(df).select("_node", "_key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_lists_of_a_leader_and_one_other_are_decided(spark):
    rows = [(1, "a", "a", 2), (1, "b", "b", 1), (2, "a", "a", 2), (2, "b", "b", 1), (2, "c", "c", 1)]
    rows += [(3, "d", "d", 1), (3, "e", "d", 1), (3, "f", "d", 1)]
    df = spark.createDataFrame(rows, "_key int, _node string, _label string, _weight int")
    rest = undecided(without_leaders(df, "_key", F.col("_weight")), "_key")
    assert sorted((r["_key"], r["_node"]) for r in rest.collect()) == [(2, "b"), (2, "c")]


def test_clusters_come_with_words_and_other_columns(spark):
    rows = [(1, "a b  c", "s"), (2, "A b c", None), (3, None, "t"), (4, " ", "u"), (None, "x y", "v")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = with_duplicate_cluster(df, "cluster", "words", ["source"]).collect()
    found = {r["source"]: (r["doc_id"], r["words"], r["cluster"]) for r in got}
    assert found["s"] == (1, 3, "near 1") and found[None] == (2, 3, "near 1")
    assert found["t"] == (3, 0, None) and found["u"][:2] == (4, 0) and found["v"][:2] == (None, 2)
    assert found["u"][2].startswith("equal ") and found["v"][2].startswith("equal ")
