import math

import numpy as np
import pytest

from tidemark.llm import neighbours, queries
from tidemark.llm.common import read_table
from tidemark.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, rank int, score string"


def brute(rows, ask, k=20):
    rows = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows]
    out = {}
    for i, q in rows:
        if ask(i):
            scores = sorted((-float((q * v).sum()), j) for j, v in rows if j != i)[:k]
            out[i] = [(j, -s) for s, j in scores]
    return out


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 9, "x") for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, expected):
    hits = sum(len({j for j, _ in got.get(i, [])} & {j for j, _ in own}) for i, own in expected.items())
    return hits / sum(map(len, expected.values()))


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_exact_scores(spark, lengths, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 70)
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(2000, 32))
    if lengths:
        vectors *= rng.uniform(0.5, 2, size=(2000, 1))
    rows = list(enumerate(vectors.tolist()))
    df = frame(spark, rows)
    got = results(nearest_neighbours(df, df.filter("vec_id % 20 = 0")))
    expected = brute(rows, lambda i: i % 20 == 0)
    assert got.keys() == expected.keys() and all(len(own) == 20 for own in got.values())
    assert recall(got, expected) >= 0.9
    values = {i: np.float32(v).astype(np.float64) for i, v in rows}
    for i, own in got.items():
        assert i not in dict(own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        for j, score in own:
            assert math.isclose(score, float(values[i] @ values[j]), rel_tol=1e-12, abs_tol=1e-12)


def test_ties_and_copies_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(i, [1.0, 0.0, 0.0]) for i in range(60, 70)]
    df = frame(spark, rows)
    got = results(nearest_neighbours(df, df.filter("vec_id = 5")))
    assert got == {5: [(j, 14.0) for j in range(21) if j != 5]}
    few = frame(spark, rows[:4])
    assert {i: len(x) for i, x in results(nearest_neighbours(few, few)).items()} == dict.fromkeys(range(4), 3)


def test_no_query_is_left_short_of_candidates(spark):
    rng = np.random.default_rng(4)
    few = list(enumerate(rng.normal(size=(10, 16)).tolist()))
    df = frame(spark, few)
    got = results(nearest_neighbours(df, df))
    assert {i: [j for j, _ in own] for i, own in got.items()} == {
        i: [j for j, _ in own] for i, own in brute(few, lambda i: True).items()
    }


@pytest.mark.parametrize("spread", [0.0, 0.05])
def test_scattered_vectors_beside_copies(spark, spread, monkeypatch):
    monkeypatch.setattr(neighbours, "HELD_ROWS", 3000)
    rng = np.random.default_rng(6)
    groups = rng.normal(size=(40, 32))[rng.integers(0, 40, 4850)]
    groups /= np.linalg.norm(groups, axis=1, keepdims=True)
    vectors = np.vstack([groups + spread * rng.normal(size=groups.shape), rng.normal(size=(150, 32))])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(enumerate(vectors.tolist()))
    df = frame(spark, rows)
    got = results(nearest_neighbours(df, df.filter("vec_id >= 4850")))
    expected = brute(rows, lambda i: i >= 4850)
    assert got.keys() == expected.keys() and all(len(own) == 20 for own in got.values())
    hits = [sum(s >= own[-1][1] - 1e-9 for _, s in got[i]) for i, own in expected.items()]
    assert sum(hits) >= 0.9 * 20 * len(expected)


def test_few_products_on_clustered_vectors(spark):
    rng = np.random.default_rng(8)
    groups = rng.normal(size=(60, 24))[rng.integers(0, 60, 6000)]
    vectors = groups + 0.05 * rng.normal(size=groups.shape)
    rows = list(enumerate((vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).tolist()))
    df = frame(spark, rows)
    found = nearest_neighbours(df, df.filter("vec_id % 20 = 0"))
    expected = brute(rows, lambda i: i % 20 == 0)
    assert recall(results(found), expected) >= 0.9
    visited = found.select("query_id", "visited").distinct().toPandas()["visited"]
    assert len(visited) == 300 and visited.mean() < 0.25 * 6000


def test_probes_come_in_order_of_their_scores():
    rng = np.random.default_rng(3)
    for limit in (0.0, 0.5, 2.3):
        at = rng.normal(size=4) * 3
        slots, scores = neighbours.probes(at, -1.0, limit)
        assert (np.diff(scores) >= 0).all() and scores.max() <= limit
        assert (slots[0] == np.floor(at)).all() and scores[0] == 0
        grid = np.stack(np.meshgrid(*[np.floor(x) + np.arange(-3, 4) for x in at]), -1).reshape(-1, 4)
        gaps = np.maximum(np.maximum(grid - at, at - grid - 1), 0)
        assert len(slots) == (np.square(gaps).sum(axis=1) <= limit).sum()
        later = neighbours.probes(at, 0.2, limit)[1]
        assert len(later) == (scores > 0.2).sum()


def test_buckets_meet_by_join_and_not_by_blocks(spark, sf_dir):
    from tidemark.llm.common import shared_table

    rows = read_table(spark, sf_dir, "embeddings").selectExpr("vec_id AS _id", "CAST(embedding AS array<double>) AS _v")
    vectors = np.array([r["_v"] for r in rows.collect()])
    hashing = neighbours.fit(vectors, len(vectors), float(np.linalg.norm(vectors, axis=1).max()), 20)
    index = neighbours.indexed(rows, hashing, vectors.shape[1])
    buckets = index.groupBy("_table", "_key").count().collect()
    assert 8 * neighbours.TABLES <= len(buckets) < 0.5 * len(vectors) * neighbours.TABLES
    asked = rows.filter("_id % 20 = 0").selectExpr("*", "-1.0D AS _above", f"{hashing.limit}D AS _limit", "0.0D AS _least")
    met = neighbours.probing(asked, hashing, vectors.shape[1]).join(
        shared_table(index.select("_table", "_key").distinct(), "buckets"), ["_table", "_key"]
    )
    assert met.count() < asked.count() * len(buckets)


def test_copies_of_an_id_leave_room_for_others(spark):
    rows = [(1, [3.0, 1.0])] * 30 + [(i, [1.0, i / 100]) for i in range(2, 40)]
    df = frame(spark, rows)
    own = results(nearest_neighbours(df, df.filter("vec_id = 39")))[39]
    assert [j for j, _ in own] == [1, *range(38, 19, -1)]


def test_unusable_vectors_take_no_part(spark):
    bad = [None, [], [0, 0], [1, None], [1, math.nan], [math.inf, 1], [1, 2, 3]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(20, [1, 1]), (21, [2, 1]), (None, [5, 5]), (21, [2, 1])]
    df = frame(spark, rows)
    assert results(nearest_neighbours(df, df)) == {20: [(21, 3.0)], 21: [(20, 3.0)]}
    assert nearest_neighbours(df.limit(0), df).count() == 0
    assert nearest_neighbours(df, df.limit(0)).count() == 0


def test_query_reaches_its_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, sf_dir, "embeddings").collect()]
    got = results(queries.op4_neighbours(spark, sf_dir))
    expected = brute(rows, lambda i: i % 20 == 0)
    assert got.keys() == expected.keys()
    assert recall(got, expected) >= 0.9
