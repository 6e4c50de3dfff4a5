"""Small documents with every awkward case, for all operators on texts."""

from __future__ import annotations

import random

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))


def awkward_texts() -> list[str | None]:
    rng = random.Random(7)
    vocabulary = ["the", "of", "and", "größe", "日本", "naïve", "x", "clown,", "end.", "A-b"]
    texts: list[str | None] = [None, "", " ", "\n\n", "one", "a b c d", "  lead and trail  "]
    texts += ["\t".join("abcdefghij") * 3, "line one\nline one\n\nline one \n", "é" * 300]
    texts += ["<|endoftext|> in the <|startoftext|>text<|endoftext|>", "a\x01b  c d e"]
    texts += ["it's we'll don't\r\nthey've 12,345.67 #$% --- \x1c \x85 end", LONG, "z" * 50_000]
    for size in (3, 19, 20, 40, 300):
        for _ in range(4):
            words = [rng.choice(vocabulary) for _ in range(size)]
            texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "  "]) for w in words))
    texts += [texts[-1], texts[-1], "same line here\n" * 40]
    return texts


def documents(spark, texts=None, copies=1):
    """``documents`` with one null id, one repeated row and columns named like outputs."""
    texts = awkward_texts() if texts is None else texts
    rows = [(i, t, None if i % 5 == 4 else "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows *= copies
    rows += [(None, "a row without an id", None, None, None)]
    df = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    clash = "n_words n_tokens kept size taken score spans component_id value start count _n rank"
    for name in clash.split():
        df = df.selectExpr("*", f"'other' AS `{name}`")
    return df


def empty(df):
    return df.limit(0)
