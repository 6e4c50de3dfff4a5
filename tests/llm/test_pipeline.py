"""Each stage of the pipeline on the rows its predecessor kept, against the plain form."""

import collections

import pytest
from fixtures import documents, empty

import corpus_pipeline
from tidemark.llm.common import read_table
from tidemark.llm.mixing import mix_sources
from tidemark.llm.neardup import near_duplicates, without_near_duplicates
from tidemark.llm.pii import _Emissions, find_spans, train
from tidemark.llm.toxicity import fit, toxicity_scores


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").cache()
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        made.append(docs)
    return made


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_toxic_documents_go(spark, sf_dir, stages):
    model = fit(stages[0], read_table(spark, sf_dir, "labels"))
    toxic = {r["doc_id"] for r in toxicity_scores(stages[0], model).collect() if r["predicted"]}
    before, after = by_id(stages[0]), by_id(stages[1])
    assert after == {i: r for i, r in before.items() if i not in toxic}
    assert len(after) > 0.8 * len(before)


def test_one_of_each_group_stays(stages):
    kept = {r["doc_id"] for r in near_duplicates(stages[1]).collect() if r["kept"]}
    assert by_id(stages[2]) == {i: r for i, r in by_id(stages[1]).items() if i in kept}


def test_personal_data_is_replaced(stages):
    after = by_id(stages[3])
    score = _Emissions(train())
    for i, row in by_id(stages[2]).items():
        (_, spans), = find_spans([(row["text"] or "").encode()], score)
        assert (after[i]["text"] != row["text"]) == bool(spans)
        assert after[i]["n_chars"] == len(after[i]["text"])
        assert (after[i]["lang"], after[i]["source"]) == (row["lang"], row["source"])


def test_documents_are_repeated_as_mixed(stages):
    expected = {r["doc_id"]: r["repeats"] for r in mix_sources(stages[3]).collect()}
    got = collections.Counter(r["doc_id"] for r in stages[4].collect())
    assert got == {i: n for i, n in expected.items() if n}
    assert set(stages[4].collect()) <= set(stages[3].collect())


def test_all_words_are_packed(stages):
    words = sum(len((r["text"] or "").split()) for r in stages[4].collect())
    rows = stages[5].collect()
    assert sum(r["size"] for r in rows) == words
    held = collections.Counter()
    for r in rows:
        held[r["shard"], r["bin"]] += r["size"]
    assert max(held.values()) <= 2048
    texts = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    seen = collections.Counter((r["shard"], r["bin"], texts[r["doc_id"]]) for r in rows if r["size"] < 2048)
    assert max(seen.values()) == 1


def test_columns_stay_but_for_the_last(stages):
    for made in stages[1:5]:
        assert made.dtypes == stages[0].dtypes


def test_awkward_rows_pass_every_stage(spark, sf_dir):
    docs = documents(spark, copies=2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents(spark).columns, name
    assert corpus_pipeline.pack_sequences(spark, docs, sf_dir).count() > 0
    nothing = empty(documents(spark))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0


def test_rows_of_one_id_follow_their_own_text(spark):
    rows = [(1, "a b c"), (7, "x y"), (7, "A B C"), (None, "a b c"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(str, (tuple(r) for r in without_near_duplicates(df).collect())))
    assert got == sorted(map(str, [(1, "a b c"), (7, "x y"), (None, None)]))


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == stages[5].columns
    total = lambda df: df.selectExpr("sum(size)", "count(*)").first()
    assert total(got) == total(stages[5])
