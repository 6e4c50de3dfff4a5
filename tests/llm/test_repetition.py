import collections
import re

from compare import connect, difference
from fixtures import awkward_texts, documents, empty

from tidemark.llm import queries
from tidemark.llm.repetition import NGRAM_LIMITS, repetition_signals

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)

    def inside(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        seen = collections.Counter(grams)
        return {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(n)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = [x for i, x in enumerate(lines) if x in lines[:i]]
    out = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(repeated),
        "dup_line_chars": sum(len(w) for x in repeated for w in WORD.findall(x)),
        "n_repeat_words": len(inside(8)),
    }
    kept = not (failed := len(words) < 20 or 100 * out["n_repeat_words"] > 30 * len(words))
    for n, share in NGRAM_LIMITS.items():
        out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in inside(n))
        kept = kept and 100 * out[f"dup_{n}gram_chars"] <= share * out["word_chars"]
    kept = kept and 100 * out["dup_line_chars"] <= 20 * out["word_chars"]
    kept = kept and 100 * out["n_dup_lines"] <= 30 * len(lines)
    return out | {"base_failed": failed, "kept": kept}


def test_measures_equal_the_plain_form(spark):
    got = {r["doc_id"]: r.asDict() for r in repetition_signals(documents(spark)).collect()}
    assert len(got) == len(awkward_texts()) + 1
    for i, text in enumerate(awkward_texts()):
        assert got[i] == {"doc_id": i} | plain(text)
    assert got[None]["n_words"] == 5


def test_repeated_rows_stay_and_empty_tables_work(spark):
    twice = repetition_signals(documents(spark, ["a b", None], copies=2))
    assert twice.count() == 5
    assert repetition_signals(empty(documents(spark))).count() == 0


def test_query_matches_its_twin(spark, sf_dir):
    df = queries.op1_repetition(spark, sf_dir)
    assert difference(df, connect(sf_dir), queries.LLM_ORACLE_SQL["op1_repetition"]) is None
