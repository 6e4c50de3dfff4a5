import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from fixtures import awkward_texts, documents, empty

from tidemark.llm import pii, queries
from tidemark.llm.common import read_table
from tidemark.llm.pii import KINDS, base_spans, personal_data, read_line, redact, train, viterbi

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HELD_OUT = (
    "please call {phone (212) 555-7788} tonight",
    "card {card 4111 1111 1111 1112} is mine",
    "write to {email bob@intranet} or wait",
    "in 1987 there were 45 of them",
    "phone {phone 415-555-2671} is hers",
    "version 2.7.18 came in 2020",
)


def plain(text):
    found = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                odd = [d * 2 if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in odd) % 10:
                    continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


@pytest.mark.parametrize("seed", range(5))
def test_base_spans_equal_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@-+ 0125é()%") for _ in range(rng.randint(0, 45)))
        assert base_spans(text) == plain(text), text
    for _ in range(300):
        text = " ".join(rng.choice(["4785380592391139", "1.2.3.4", "a@b.c", "255.256.1.2.3.4.5", "+1 (743) 555-3824", "x"]) for _ in range(8))
        assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000):
        base_spans(text)


def test_viterbi_equals_all_paths():
    model = train()
    rng = np.random.default_rng(3)
    sizes = np.array([1, 3, 2, 4, 1])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    emission = rng.normal(size=(sizes.sum(), pii.N_LABELS)) * 3
    got = viterbi(emission, starts, sizes, model)
    for start, size in zip(starts, sizes):
        def value(path):
            own = sum(emission[start + t, label] for t, label in enumerate(path))
            steps = sum(model.transition[a, b] for a, b in zip(path, path[1:]))
            return own + steps + model.first[path[0]] + model.last[path[-1]]

        best = max(itertools.product(range(pii.N_LABELS), repeat=int(size)), key=value)
        assert tuple(got[start : start + size]) == best


def labels_of(line):
    """The labels the model gives to the tokens of a marked line, from its spans."""
    tokens, _ = read_line(line)
    text = " ".join(tokens)
    (spans,) = pii.crf_spans([text.encode()], pii._Emissions(train()))
    out, at = [], 0
    for token in tokens:
        inside = [k for s, k, e in spans if s < at + len(token) and at < e]
        out.append(inside[0] if inside else None)
        at += len(token) + 1
    return out


def kinds_of(line):
    return [None if label == 0 else (label - 1) // 2 for label in read_line(line)[1]]


def test_crf_learns_its_table_and_reads_new_lines():
    right = sum(labels_of(line) == kinds_of(line) for line in pii.LABELLED_LINES)
    assert right >= 0.95 * len(pii.LABELLED_LINES)
    assert [labels_of(line) for line in HELD_OUT] == [kinds_of(line) for line in HELD_OUT]


def test_spans_count_code_points_and_keep_the_base(spark):
    texts = [
        "größe: a.b@c.de, ruf (212) 555-7788.\nip 1.2.3.4!",
        "é 4785 3805 9239 1139 und 4111 1111 1111 1112",
        None,
        "",
        "nichts",
    ]
    got = {r["doc_id"]: r for r in personal_data(documents(spark, texts)).collect()}
    assert got[0]["spans"] == "email:7:15,phone:21:35,ip:40:47"
    assert (got[0]["n_email"], got[0]["n_ip"], got[0]["n_phone"], got[0]["n_added"]) == (1, 1, 0, 1)
    assert got[0]["base_sha256"] == hashlib.sha256(b"email:7:15,ip:40:47").hexdigest()
    base = base_spans(texts[1])
    assert "card:26:45" in got[1]["spans"] and got[1]["n_card"] == len(base)
    for i in (2, 3, 4):
        assert (got[i]["spans"], got[i]["base_sha256"]) == ("", hashlib.sha256(b"").hexdigest())


def test_awkward_documents(spark):
    texts = awkward_texts()
    got = {r["doc_id"]: r for r in personal_data(documents(spark, texts)).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        assert [got[i][f"n_{k}"] for k in KINDS] == [
            sum(s[1] == n for s in plain(text or "")) if len(text or "") < 1000 else got[i][f"n_{k}"]
            for n, k in enumerate(KINDS)
        ]
    assert personal_data(empty(documents(spark))).count() == 0
    assert personal_data(documents(spark, ["a", None], copies=2)).count() == 5


def test_redaction_replaces_spans_only(spark):
    df = documents(spark, ["mail a@b.de or 1.2.3.4.", None, "plain"])
    out = redact(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[0] == "mail <email> or <ip>."
    assert got[1] is None and got[2] == "plain"


def test_query_equals_the_patterns(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op10_personal_data(spark, sf_dir).collect()}
    for row in read_table(spark, sf_dir, "documents").collect():
        spans = plain(row["text"] or "")
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert got[row["doc_id"]]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(got[row["doc_id"]]["spans"].split(",")) or not text
