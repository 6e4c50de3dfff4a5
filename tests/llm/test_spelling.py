import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference
from fixtures import LONG, documents, empty

from tidemark.llm import queries, spelling
from tidemark.llm.spelling import (
    LetterTree,
    cell_of,
    forest_of,
    in_reach,
    letter_counts,
    one_edit,
    spelling_groups,
    word_counts,
)


def plain_words(rows):
    """Words and their occurrences, an occurrence at a time."""
    found = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            check = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if check % 199 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def distance_is_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if distance_is_one(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return out


def misspelled(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abcdeéüÿxyz")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéÿ") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words += [misspelled(rng, w) for w in words for _ in range(3)]
    words += [misspelled(rng, w) for w in words[60:]] + ["ab" * 40, "ab" * 40 + "a", "listen", "silent", "enlist"]
    rows = []
    for i in range(80):
        chosen = rng.choices(words, weights=[1 + 40 // (1 + j) for j in range(len(words))], k=120)
        chosen = [w.capitalize() if rng.random() < 0.2 else w for w in chosen]
        rows.append((i, rng.choice([" ", "-", "\n", "×1", "'"]).join(chosen)))
    return rows + [(None, "lonely words " * 3), (90, None), (91, ""), (92, LONG), (3, rows[3][1])]


def as_set(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("cell", [4096, 40])
def test_groups_equal_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    rows = corpus(cell)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS word", "1 AS n", "'y' AS form")
    assert as_set(spelling_groups(df)) == plain(rows)


def test_query_equals_its_sql(spark, sf_dir):
    df = queries.op11_spelling_variants(spark, sf_dir)
    assert difference(df, connect(sf_dir), queries.LLM_ORACLE_SQL["op11_spelling_variants"]) is None


def test_cells_hold_their_words_and_few_of_them(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 50)
    rng = random.Random(1)
    some = sorted({"".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(2000)})
    anagrams = sorted({"".join(rng.sample("opqrstu", 7)) for _ in range(300)})
    words = [w.encode() for w in some + anagrams]
    forest = forest_of(spark.createDataFrame([(w, 5) for w in some + anagrams], "word string, n bigint"))
    counts = letter_counts(words)
    cells = cell_of(forest, np.full(len(words), 7), counts)
    assert (forest["lo"][cells] <= counts).all() and (counts <= forest["hi"][cells]).all()
    held = Counter(cells.tolist())
    assert all(n <= 50 * forest["parts"][cell] for cell, n in held.items())
    assert max(forest["parts"][cells]) == -(-len(anagrams) // 50)


def test_boxes_out_of_reach_are_pruned_and_none_within():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcdefghijkl") for _ in range(8)) for _ in range(3000)})
    tree = LetterTree([w.encode() for w in words])
    queries_ = letter_counts([w.encode() for w in words[:50]])[:, tree.used]
    row, leaf = in_reach(*tree.boxes, 0, queries_, 2)
    visited = {(r, p) for r, n in zip(row.tolist(), leaf.tolist()) for p in tree.order[slice(*tree.span[n])]}
    for r in range(50):
        close = np.flatnonzero(np.abs(tree.counts - queries_[r]).sum(axis=1) <= 2)
        assert all((r, p) in visited for p in close)
    leaves = (tree.boxes[2] < 0).sum()
    assert len(row) < 0.5 * 50 * leaves


def test_one_edit_by_letters():
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(4))
        b = "".join(rng.choice("ab") for _ in range(rng.choice([4, 5])))
        rows = [np.frombuffer(x.encode(), dtype=np.uint8)[None, :] for x in (a, b)]
        assert bool(one_edit(*rows)[0]) == distance_is_one(a, b)


def test_empty_tables_and_tables_without_words(spark):
    df = documents(spark)
    assert spelling_groups(empty(df)).count() == 0
    assert spelling_groups(documents(spark, ["short one", None, ""])).count() == 0
    assert {r["word"] for r in word_counts(df, "doc_id", "text").collect()} == set(
        plain_words([(r["doc_id"], r["text"]) for r in df.collect()])
    )
