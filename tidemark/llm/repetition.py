"""Repetition coverage: characters inside repeated n-grams and lines (operator 1)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, mix64

# The largest share, in percent, of a text's word characters that may lie inside n-grams
# found twice or more, by n, and inside lines equal to an earlier line; and of its lines.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_CHARS_LIMIT = 20
LINE_COUNT_LIMIT = 30

SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E6C63D0876A9A47)


def ngram_starts(
    ids: np.ndarray, docs: np.ndarray, lengths: list[int], seed: int = 1
) -> dict[int, np.ndarray]:
    """For each length n, where the n-grams start that occur twice in their document.

    ``ids`` are the word numbers of documents one after another, ``docs`` the document
    of each word (ascending). A rolling hash is extended from one length to the next.
    An n-gram can only occur twice if the shorter one at its place does, so each length
    looks at the places left by the one before. Equal hashes are compared word by word.
    """
    found: dict[int, np.ndarray] = {}
    words = mix64(ids + (seed << 40))
    hashes = mix64(docs + (seed << 41))
    places = np.arange(len(ids))
    reached = 0
    for n in sorted(lengths):
        for step in range(reached, n):
            ahead = places + step
            inside = ahead < len(ids)
            places, ahead, hashes = places[inside], ahead[inside], hashes[inside]
            same = docs[ahead] == docs[places]
            places, hashes = places[same], hashes[same]
            hashes = hashes * _BASE + words[places + step]
        reached = n
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        equal = ranked[1:] == ranked[:-1]
        left, right = places[order[:-1][equal]], places[order[1:][equal]]
        for step in range(n):
            if not np.array_equal(ids[left + step], ids[right + step]):
                return ngram_starts(ids, docs, lengths, seed + 1)  # two texts, one hash
        if not np.array_equal(docs[left], docs[right]):
            return ngram_starts(ids, docs, lengths, seed + 1)
        twice = np.zeros(len(places), dtype=bool)
        twice[order[:-1][equal]] = True
        twice[order[1:][equal]] = True
        places, hashes = places[twice], hashes[twice]
        found[n] = places
    return found


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """The words that lie in a window of n words from one of the starts."""
    edges = np.zeros(size + 1, dtype=np.int64)
    edges[starts] += 1
    np.add.at(edges, starts + n, -1)
    return np.cumsum(edges[:-1]) > 0


def repetition_signals(
    documents: DataFrame,
    limits: Mapping[int, int] = NGRAM_LIMITS,
    line_chars_limit: int = LINE_CHARS_LIMIT,
    line_count_limit: int = LINE_COUNT_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Repetition measures and a verdict for every row of ``documents``.

    Words are runs of bytes other than space and 0x09-0x0D. The columns: n_words,
    word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines (equal to an earlier line), dup_line_chars (word characters in those),
    n_repeat_words (words in 8-word windows found twice or more, the first included),
    one ``dup_<n>gram_chars`` per length of ``limits`` (word characters inside n-grams
    found twice or more), base_failed (under 20 words, or over 30 % of the words in
    repeated 8-word windows) and kept (base passed and no share above its limit).

    A null text has no words, as an empty one: it fails. Ids may be null or repeat.
    Other columns are ignored. Whole texts are measured, whatever their length.
    """
    lengths = sorted({*limits, 8})
    shown = sorted(limits)

    def work(texts: list[bytes | None]) -> dict[str, list]:
        texts = [text or b"" for text in texts]
        words: list[bytes] = []
        sizes, symbols, lines_with, repeats, repeat_chars = [], [], [], [], []
        for text in texts:
            own = text.split()
            words += own
            sizes.append(len(own))
            symbols.append(len(text) - len(text.translate(None, SYMBOLS)))
            lines = [line for line in text.split(b"\n") if line.strip()]
            lines_with.append(len(lines))
            distinct = set(lines)
            repeats.append(len(lines) - len(distinct))
            chars = sum(map(_chars, lines)) - sum(map(_chars, distinct)) if repeats[-1] else 0
            repeat_chars.append(chars)
        numbers = dict(zip(dict.fromkeys(words), count()))
        ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        widths = np.fromiter((len(w.decode()) for w in numbers), np.int64, len(numbers))[ids]
        n_words = np.array(sizes, dtype=np.int64)
        docs = np.repeat(np.arange(len(texts)), n_words)

        def by_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(docs, weights=values, minlength=len(texts)).astype(np.int64)

        word_chars = by_text(widths)
        starts = ngram_starts(ids, docs, lengths)
        inside = {n: covered(starts[n], n, len(ids)) for n in lengths}
        repeat_words = by_text(inside[8])
        base_failed = (n_words < 20) | (100 * repeat_words > 30 * n_words)
        kept = ~base_failed
        made = {
            "n_words": n_words,
            "word_chars": word_chars,
            "n_symbols": symbols,
            "n_lines": lines_with,
            "n_dup_lines": repeats,
            "dup_line_chars": repeat_chars,
            "n_repeat_words": repeat_words,
        }
        for n in shown:
            made[f"dup_{n}gram_chars"] = by_text(np.where(inside[n], widths, 0))
            kept &= 100 * made[f"dup_{n}gram_chars"] <= limits[n] * word_chars
        kept &= 100 * np.array(repeat_chars) <= line_chars_limit * word_chars
        kept &= 100 * np.array(repeats) <= line_count_limit * np.array(lines_with)
        return made | {"base_failed": base_failed, "kept": kept}

    longs = "n_words word_chars n_symbols n_lines n_dup_lines dup_line_chars n_repeat_words"
    longs = longs.split() + [f"dup_{n}gram_chars" for n in shown]
    fields = ", ".join(f"{name} bigint" for name in longs) + ", base_failed boolean, kept boolean"
    return map_texts(documents, id_col, text_col, fields, work)


def _chars(line: bytes) -> int:
    return sum(len(word.decode()) for word in line.split())
