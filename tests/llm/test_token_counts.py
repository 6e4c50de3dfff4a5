import public_tokenizers
import pytest
from fixtures import awkward_texts, documents, empty
from tokenizers import Tokenizer

from tidemark.llm import queries
from tidemark.llm.common import read_table
from tidemark.llm.token_counts import byte_batches, pieces_of, token_counts, whole

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


@pytest.mark.parametrize("name", FILES)
def test_counts_equal_the_library_on_whole_texts(spark, name):
    path = public_tokenizers.path(name)
    assert pieces_of(path) is not whole
    model = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in token_counts(documents(spark), path, limit=40).collect()}
    for i, text in enumerate(awkward_texts()):
        n = len(model.encode(text or "", add_special_tokens=False).ids)
        size = len((text or "").encode())
        assert tuple(got[i]) == (i, size, n, n > 40)
    assert got[None]["n_tokens"] > 0


def test_sentencepiece_file(spark):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    for row in token_counts(documents(spark), path).filter("doc_id is not null").collect():
        assert row["n_tokens"] == len(model.encode(awkward_texts()[row["doc_id"]] or ""))


def test_query_equals_the_library(spark, sf_dir):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op8_token_counts(spark, sf_dir).collect()}
    rows = read_table(spark, sf_dir, "documents").collect()
    assert got == {r["doc_id"]: len(model.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows}


def test_empty_table_and_repeated_rows(spark):
    path = public_tokenizers.path(FILES[0])
    assert token_counts(empty(documents(spark)), path).count() == 0
    assert token_counts(documents(spark, ["a b", None], copies=2), path).count() == 5


def test_batches_are_balanced_and_whole():
    batches = list(byte_batches(["ab"] * 100 + ["c" * 500], limit=100))
    assert sum(batches, []) == ["ab"] * 100 + ["c" * 500]
    assert max(len(b) for b in batches) <= 10
