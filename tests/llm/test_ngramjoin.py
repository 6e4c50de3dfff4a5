import random

import numpy as np
import pytest
from compare import connect, difference
from fixtures import awkward_texts, documents, empty

from tidemark.llm import ngramjoin, queries
from tidemark.llm.ngramjoin import class_counts, ngram_join, prefix_size


def plain(texts, width=3, share=90):
    """Set size and component by row number, from all pairs of word tuples."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        held = min(width, len(words)) or 1
        sets.append({tuple(words[i : i + held]) for i in range(len(words) - held + 1)})
    least = list(range(len(texts)))
    again = True
    while again:
        again = False
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= share * len(a | sets[j]):
                    low = min(least[i], least[j])
                    again |= least[i] != low or least[j] != low
                    least[i] = least[j] = low
    return [(len(s), low) for s, low in zip(sets, least)]


def family(seed):
    """Copies with some words changed, chains, and a passage that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size, copies in ((200, 30), (120, 25), (60, 12), (40, 10), (10, 6), (4, 4), (3, 3)):
        origin = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            words = list(origin)
            for _ in range(rng.randint(0, max(1, size // 40))):
                words[rng.randrange(size)] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    step = [rng.choice(vocabulary) for _ in range(150)]
    for i in range(15):
        texts.append(" ".join(step))
        step[i * 9] = f"step{i}"
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 9))) for _ in range(50)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_all_pairs(spark, seed):
    texts = family(seed) + awkward_texts()
    df = documents(spark, texts)
    found = {r["doc_id"]: r for r in ngram_join(df).collect()}
    assert len(found) == len(texts) + 1
    for i, (size, low) in enumerate(plain(texts)):
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (size, low), i
    assert found[None]["component_id"] is None


def test_query_equals_its_sql(spark, sf_dir):
    df = queries.op13_ngram_join(spark, sf_dir)
    assert difference(df, connect(sf_dir), queries.LLM_ORACLE_SQL["op13_ngram_join"]) is None


def test_split_hubs_and_small_tables_of_counts_change_nothing(spark, monkeypatch):
    texts = family(7)
    expected = {r["doc_id"]: r["component_id"] for r in ngram_join(documents(spark, texts)).collect()}
    monkeypatch.setattr(ngramjoin, "HUB", 2)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join(documents(spark, texts)).collect()}
    assert found == expected


def test_filter_keeps_all_that_is_asked_for_and_little_else(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "_rep")
    wanted = rows.filter("_rep % 10 = 3").union(rows.limit(0))
    kept = {r["_rep"] for r in ngramjoin.asked_for(rows, wanted, "_rep").collect()}
    assert kept >= set(range(3, 20_000, 10)) and len(kept) < 2100
    assert ngramjoin.asked_for(rows, wanted.limit(0), "_rep").count() == 0


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(3)
    for _ in range(300):
        common = rng.randint(1, 80)
        a = set(range(common)) | {1000 + i for i in range(rng.randint(0, 6))}
        b = set(range(common)) | {2000 + i for i in range(rng.randint(0, 6))}
        if 100 * len(a & b) < 90 * len(a | b):
            continue
        order = list(a | b)
        rng.shuffle(order)
        first = [set([x for x in order if x in s][: prefix_size(len(s))]) for s in (a, b)]
        assert first[0] & first[1]


def test_class_counts_grow_with_the_set():
    for size, width in ((10, 1), (255 * 64, 1), (300 * 64, 2), (70_000 * 64, 4)):
        assert len(class_counts(np.arange(size, dtype=np.int64))) == 64 * width


def test_repeated_rows_ids_and_empty_tables(spark):
    df = documents(spark, ["a b c d", "a b c d", "a b", None], copies=2)
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join(df.filter("doc_id is not null")).collect())
    assert found == sorted([(0, 2, 0), (1, 2, 0), (2, 1, 2), (3, 0, 3)] * 2)
    same = spark.createDataFrame([(5, "x y z"), (5, "p q r s"), (3, "p q r s")], "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join(same).collect())
    assert found == [(3, 2, 3), (5, 1, 5), (5, 2, 3)]
    assert ngram_join(empty(df)).count() == 0
