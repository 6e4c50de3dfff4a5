import zlib

import numpy as np
import pytest
from fixtures import documents, empty

from tidemark.llm import queries, toxicity
from tidemark.llm.common import read_table
from tidemark.llm.toxicity import build_index, calibrate, fit, nearest, reject_toxic, toxicity_scores, weigh


@pytest.mark.parametrize("seed", range(4))
def test_nearest_equals_all_cosines(seed):
    rng = np.random.default_rng(seed)
    size, n = 30, 700
    idf = rng.uniform(0.5, 3, size)
    vectors = [
        weigh({int(t): int(rng.integers(1, 5)) for t in rng.choice(size, rng.integers(0, 6), replace=False)}, idf)
        for _ in range(n)
    ]
    index = build_index([f"t{i}" for i in range(size)], idf, vectors, np.zeros(n), np.arange(n))
    dense = np.zeros((n, size))
    for i, own in enumerate(index.ids.tolist()):
        dense[i, vectors[own][0]] = vectors[own][1]
    for i in range(0, n, 7):
        query = np.zeros(size)
        query[vectors[i][0]] = vectors[i][1]
        scores = np.round(dense @ query, 9)
        order = [p for p in np.lexsort((np.arange(n), -scores)) if scores[p] > 0][:10]
        places, cosines = nearest(index, *vectors[i], 10)
        assert places.tolist() == order
        assert np.allclose(cosines, scores[order])


def test_calibration_rises_and_is_smoothed():
    rng = np.random.default_rng(1)
    votes = rng.uniform(0, 1, 2000).tolist()
    labels = (rng.uniform(0, 1, 2000) < np.array(votes) ** 2).astype(int)
    made = calibrate([*votes, None, None], np.array([*labels, 1, 0]))
    assert (np.diff(made.shares) >= 0).all() and made(None) == 0.5
    assert abs(made(0.5) - 0.25) < 0.1 and made(1.0) <= 1


def labelled(spark, n=600):
    texts = [f"plain words number {'abc'[i % 3]} and more" + (" nasty clown" if i % 4 == 0 else "") for i in range(n)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(n)] + [(None, 1, 1), (5, 0, None)]
    return texts, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_terms_decide_whatever_the_length(spark):
    texts, labels = labelled(spark)
    model = fit(documents(spark, texts), labels)
    assert set(model.index.vocabulary) == {"nasty", "clown"}
    new = [None, "", "fine text", "a clown", "w " * 100_000 + "Nasty clown, clown!"]
    got = {r["doc_id"]: r for r in toxicity_scores(documents(spark, new), model).collect()}
    assert [got[i]["predicted"] for i in range(5)] == [0, 0, 0, 1, 1]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[0]["evidence"] == "" and got[4]["evidence"].count(":") == 3
    assert got[None]["held_out"] is False
    assert reject_toxic(documents(spark, new), model).count() == 4


def test_held_out_labels_are_not_used(spark):
    texts, labels = labelled(spark)
    df = documents(spark, texts)
    flipped = labels.selectExpr(
        "doc_id", "quality", "IF(pmod(crc32(CAST(doc_id AS STRING)), 4) = 2, 1 - toxic, toxic) AS toxic"
    )
    one, two = ([r.asDict() for r in toxicity_scores(df, fit(df, x)).orderBy("doc_id").collect()] for x in (labels, flipped))
    assert one == two
    for row in one:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2 and row["doc_id"] is not None)


def test_tables_without_rows(spark):
    texts, labels = labelled(spark, 40)
    df = documents(spark, texts)
    bare = fit(df, empty(labels))
    assert {r["score"] for r in toxicity_scores(df, bare).collect()} == {0.0}
    assert toxicity_scores(empty(df), fit(empty(df), labels)).count() == 0
    bounded = fit(df, labels, max_examples=10)
    assert len(bounded.index.ids) == 10


def test_query_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = {r["doc_id"]: r for r in queries.op5_toxicity(spark, sf_dir).collect()}
    assert len(rows) == read_table(spark, sf_dir, "documents").count()
    labels = read_table(spark, sf_dir, "labels").filter("toxic IS NOT NULL").collect()
    test = [(rows[r["doc_id"]], r["toxic"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    found = sum(r["predicted"] for r, _ in test)
    assert found and sum(r["predicted"] * y for r, y in test) >= 0.9 * found
    # Some positive labels are noise: rows without any term that goes with the label.
    assert sum(r["predicted"] * y for r, y in test) >= 0.45 * sum(y for _, y in test)
    assert toxicity.MAX_EXAMPLES >= 1000
