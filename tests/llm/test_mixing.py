import pytest
from compare import connect, difference
from fixtures import documents, empty

from tidemark.llm import queries
from tidemark.llm.mixing import capped_targets, cyclic_weights, mix_sources

PYTHON = ("Python", "Pandas", "Arrow")


def water(sizes, weights, total, epochs):
    """Targets by repeated resharing."""
    open_, targets = dict(weights), {}
    while True:
        rest = total - sum(targets.values())
        share = {k: rest * w / sum(open_.values()) for k, w in open_.items()}
        above = [k for k in share if share[k] >= epochs * sizes[k]]
        if not above:
            return targets | share
        for k in above:
            targets[k] = epochs * sizes[k]
            del open_[k]
        if not open_:
            return targets


@pytest.mark.parametrize("total", [10, 1000, 2500, 5000])
def test_targets_equal_repeated_resharing(spark, total):
    sizes = {"a": 1, "b": 100, "c": 700, "d": 10, "e": 900, "f": 3}
    weights = {k: i % 3 + 1 for i, k in enumerate(sizes)}
    rows = [(k, sizes[k], weights[k]) for k in sizes]
    df = spark.createDataFrame(rows, "source string, source_size bigint, weight bigint")
    got = {r["source"]: r["target"] for r in capped_targets(df, total, 3).collect()}
    for k, target in water(sizes, weights, total, 3).items():
        assert got[k] == pytest.approx(target)


def test_weights_follow_code_points_with_null_last(spark):
    names = ["b", "a", "é", "aa", "Z", None, "", "日"]
    df = spark.createDataFrame([(n,) for n in names], "source string")
    got = {r[0]: r[1] for r in cyclic_weights(df, "source").collect()}
    ordered = [*sorted(n for n in names if n is not None), None]
    assert got == {n: i % 3 + 1 for i, n in enumerate(ordered)}


def test_taken_words_meet_the_targets(spark):
    texts = [" ".join("w" * (i % 13 + 1)) if i % 11 else None for i in range(400)] + [""]
    rows = mix_sources(documents(spark, texts)).collect()
    assert len(rows) == len(texts) + 1
    by_source = {}
    for r in rows:
        assert r["taken"] == r["repeats"] * r["size"] <= 3 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 7
    again = mix_sources(documents(spark, texts)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_empty_sources_and_tables(spark):
    assert mix_sources(empty(documents(spark))).count() == 0
    for row in mix_sources(documents(spark, [None, "", " "])).filter("source is not null").collect():
        assert (row["size"], row["taken"], row["target"]) == (0, 0, 0.0)
    assert mix_sources(documents(spark, ["a b", None], copies=3)).count() == 7


def test_only_sources_with_a_weight_are_taken(spark):
    weights = spark.createDataFrame([("src0", 1)], "source string, weight bigint")
    mixed = mix_sources(documents(spark), weights, total=500)
    taken = {r[0]: r[1] for r in mixed.groupBy("source").sum("taken").collect()}
    assert taken["src1"] == taken[None] == 0 < taken["src0"]


def test_query_matches_its_twin_without_python(spark, sf_dir):
    df = queries.op3_mixing(spark, sf_dir)
    assert difference(df, connect(sf_dir), queries.LLM_ORACLE_SQL["op3_mixing"]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in PYTHON)
