"""Token counts: batch encoding that returns lengths only (operator 8).

Texts are split at boundaries no token and no rule of the tokenizer reaches across, and
the pieces are encoded in batches balanced by bytes. A piece that a worker has met
before is not encoded again: workers keep the lengths of up to ``MEMO_PIECES`` pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts

MEMO_PIECES = 1_000_000
MEMO_CHARS = 64
ENCODE_BYTES = 262_144

# White space in either view, Python's or the tokenizers'.
_UNEVEN = re.compile(r"\s\s|[^\S \n]|\x01")
_SAFE = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def whole(text: str) -> list[str]:
    return [text]


def drop_space_pieces(text: str) -> list[str]:
    """Pieces for a tokenizer that drops white space: cut at blanks and line ends."""
    return text.replace("\n", " ").split(" ")


def leading_space_pieces(text: str) -> list[str]:
    """Pieces for a byte-level tokenizer, whose words carry the blank before them.

    A cut is made before a single blank and around a single line end between other
    characters; longer white space stays inside a piece.
    """
    if _UNEVEN.search(text):
        return _SAFE.split(text)
    return text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").split("\x01")


def pieces_of(path: str) -> Callable[[str], list[str]]:
    """The cut that is safe for a tokenizer file; whole texts where none is known."""
    if not path.endswith(".json"):
        return whole
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kind = spec.get("pre_tokenizer") or {}
    parts = kind.get("pretokenizers", [kind])
    if any(token["lstrip"] or token["rstrip"] for token in spec["added_tokens"]):
        return whole
    if any(part.get("add_prefix_space") for part in parts):
        return whole
    first = parts[0]
    if spec.get("normalizer") is None and first.get("use_regex"):
        return leading_space_pieces
    # Pieces are the matches of a pattern whose classes all leave white space out.
    pattern = (first.get("pattern") or {}).get("Regex", "")
    if (first.get("behavior"), first.get("invert")) == ("Removed", True) and (
        pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    ):
        return drop_space_pieces
    return whole


def byte_batches(pieces: list[str], limit: int = ENCODE_BYTES) -> Iterator[list[str]]:
    """Batches of about equal bytes, each piece whole."""
    batch: list[str] = []
    size = 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece) + 8
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


class Counter:
    """Token counts by one tokenizer file, with what a worker has met so far."""

    def __init__(self, path: str):
        self.cut = pieces_of(path)
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            model = load_tokenizer(path)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: [
                len(made) for made in model.encode_batch_fast(texts, add_special_tokens=False)
            ]

    def count(self, texts: list[str]) -> list[int]:
        """The lengths of texts; the memo is emptied when it is full."""
        cut = [self.cut(text) for text in texts]
        known = self.known
        new = list(set().union(*cut).difference(known))
        for batch in byte_batches(new):
            known.update(zip(batch, self.lengths(batch)))
        counts = [sum(map(known.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > MEMO_CHARS:
                del known[piece]
        if len(known) > MEMO_PIECES:
            known.clear()
        return counts


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter of a tokenizer file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(
    documents: DataFrame,
    path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``documents``.

    ``path`` names a ``.json`` file of the tokenizers library or a ``.model`` file of
    sentencepiece, present on every machine. No special tokens are added; their strings
    inside a text are handled as the library does by default. A null text counts as
    empty, with 0 tokens. Ids may be null or repeat, rows are never merged. Other
    columns are ignored. Texts are encoded whole, whatever their length.
    """

    def work(texts: list[bytes | None]) -> dict[str, list]:
        texts = [text or b"" for text in texts]
        counts = counter(path).count([text.decode() for text in texts])
        return {
            "n_bytes": [len(text) for text in texts],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    fields = "n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_texts(documents, id_col, text_col, fields, work)


