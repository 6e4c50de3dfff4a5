"""Operators against brute force, and heavy keys against light ones, on small data."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, asof_join_bucketed
from tidemark.operators.changelog import apply_changelog, changelog_diff
from tidemark.operators.keyed import running_state
from tidemark.operators.membership import latest_membership
from tidemark.operators.skew import heavy_key_slices, with_slice
from tidemark.operators.windowjoin import co_group_apply
from tidemark.session import session_conf
from tidemark.sinks.widecolumn import to_cells
from tidemark.sources.widecolumn import read_rows

START = datetime(2024, 1, 1)
FEW = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
POINTS = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40)), min_size=1, max_size=40
)


def moment(second):
    return START + timedelta(seconds=second)


def sides(spark, left, right):
    orders = spark.createDataFrame(
        [(k, moment(t), i) for i, (k, t) in enumerate(left)], "k STRING, lt TIMESTAMP, l INT"
    )
    rates = spark.createDataFrame(
        [(k, moment(t), i) for i, (k, t) in enumerate(right)], "k STRING, rt TIMESTAMP, r INT"
    )
    return orders, rates


def brute_force_asof(left, right):
    pairs = []
    for i, (key, time) in enumerate(left):
        known = [(t, j) for j, (k, t) in enumerate(right) if k == key and t <= time]
        if known:
            pairs.append((i, max(known)[1]))
    return sorted(pairs)


def pairs_of(df):
    return sorted((row.l, row.r) for row in df.select("l", "r").collect())


@FEW
@given(left=POINTS, right=POINTS)
def test_asof_variants_equal_brute_force(spark, left, right):
    orders, rates = sides(spark, left, right)
    expected = brute_force_asof(left, right)
    args = (orders, rates, ["k"], "lt", "rt")
    assert pairs_of(asof_join(*args, arrival=["r"])) == expected
    assert pairs_of(asof_join(*args, arrival=["r"], rows_per_task=3)) == expected
    assert pairs_of(asof_join_bucketed(*args, 7, arrival=["r"])) == expected


def test_asof_with_a_third_of_the_rows_in_one_key(spark):
    rng = random.Random(1)
    left = [("hot", rng.randrange(500)) for _ in range(400)]
    left += [(f"k{rng.randrange(40)}", rng.randrange(500)) for _ in range(800)]
    # One key and time on a hundred rows: no slice of time can part them.
    left += [("hot", 250)] * 100
    right = [("hot", rng.randrange(500)) for _ in range(60)]
    right += [(f"k{rng.randrange(40)}", rng.randrange(500)) for _ in range(200)]
    orders, rates = sides(spark, left, right)
    expected = brute_force_asof(left, right)
    for size in (50, 200):
        sliced = asof_join(orders, rates, ["k"], "lt", "rt", arrival=["r"], rows_per_task=size)
        assert pairs_of(sliced) == expected


def test_slices_hold_no_more_than_asked_for(spark):
    # Nine tenths of the heavy key lie in the first second of a long time line.
    rows = [("hot", i) for i in range(900)] + [("hot", 10**9 + i) for i in range(100)]
    rows += [("cold", i) for i in range(20)]
    points = spark.createDataFrame(rows, "k STRING, us BIGINT")
    slices = heavy_key_slices(points, ["k"], "us", rows_per_task=100)
    assert slices.even
    assert [row.k for row in slices.table.collect()] == ["hot"]
    placed = with_slice(points, slices, ["k"], "us").groupBy("k", "_slice").count()
    assert placed.agg(F.max("count")).first()[0] <= 100
    assert placed.filter("k = 'cold'").count() == 1
    assert heavy_key_slices(points, ["k"], "us", rows_per_task=1000) is None


def test_copies_of_one_time_make_slices_uneven(spark):
    points = spark.createDataFrame([("hot", 5)] * 50 + [("hot", 9)], "k STRING, us BIGINT")
    assert not heavy_key_slices(points, ["k"], "us", rows_per_task=10).even
    assert heavy_key_slices(points, ["k"], "us", rows_per_task=50).even


@FEW
@given(points=POINTS)
def test_running_state_in_slices_equals_brute_force(spark, points):
    rows = [(k, moment(t), i, i % 5) for i, (k, t) in enumerate(points)]
    df = spark.createDataFrame(rows, "k STRING, t TIMESTAMP, i INT, v INT")
    expected, counts, sums = {}, defaultdict(int), defaultdict(int)
    for key, _, i, v in sorted(rows, key=lambda row: (row[1], row[2])):
        counts[key] += 1
        sums[key] += v
        expected[i] = (counts[key], sums[key])
    for size in (4, 1000):
        result = running_state(df, "k", "v", ["t", "i"], rows_per_task=size)
        assert {r.i: (r.running_count, r.running_sum) for r in result.collect()} == expected


def test_latest_before_the_joins_equals_joins_before_latest(spark):
    rng = random.Random(2)
    users = [(rng.randrange(5), f"n{i}", rng.choice([None, i]), i) for i in range(30)]
    classes = [(rng.randrange(4), rng.choice([None, f"c{i}"]), i) for i in range(20)]
    links = [(rng.randrange(5), rng.randrange(6), rng.choice("xyz"), i) for i in range(40)]
    u = spark.createDataFrame(users, "uid INT, name STRING, age INT, o INT")
    c = spark.createDataFrame(classes, "cid INT, cname STRING, o INT")
    cu = spark.createDataFrame(links, "uid INT, cid INT, utype STRING, o INT")
    mine = latest_membership(u, c, cu, ["o"])
    u.createOrReplaceTempView("u")
    c.createOrReplaceTempView("c")
    cu.createOrReplaceTempView("cu")
    joined = spark.sql(
        """SELECT u.uid, c.cid,
             max_by(u.name, u.o) FILTER (WHERE u.name IS NOT NULL) AS name,
             max_by(u.age, u.o) FILTER (WHERE u.age IS NOT NULL) AS age,
             max_by(c.cname, c.o) FILTER (WHERE c.cname IS NOT NULL) AS cname,
             max_by(cu.utype, cu.o) FILTER (WHERE cu.utype IS NOT NULL) AS utype
           FROM u, c, cu WHERE u.uid = cu.uid AND c.cid = cu.cid GROUP BY u.uid, c.cid"""
    )
    assert sorted(mine.collect(), key=str) == sorted(joined.collect(), key=str)


@FEW
@given(
    before=st.dictionaries(st.integers(0, 9), st.sampled_from(["x", "y", None])),
    after=st.dictionaries(st.integers(0, 9), st.sampled_from(["x", "y", None])),
)
def test_changes_applied_to_the_old_give_the_new(spark, before, after):
    old = spark.createDataFrame(list(before.items()), "k INT, v STRING")
    new = spark.createDataFrame(list(after.items()), "k INT, v STRING")
    folded = apply_changelog(old, changelog_diff(old, new, ["k"]))
    assert sorted(map(tuple, folded.collect()), key=str) == sorted(after.items(), key=str)


def test_cells_and_rows_are_inverse(spark):
    rows = spark.sql(
        "SELECT concat('r', id) AS rowkey, named_struct('a', string(id), 'b', int(id)) AS info,"
        " named_struct('c', 'x') AS other FROM range(10)"
    )
    back = read_rows(to_cells(rows, F.lit(1)), rows.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("batch", [2, 10_000])
def test_co_group_gives_pairs_and_lone_rows(spark, batch):
    left = [("hot", i) for i in range(7)] + [("cold", 0), ("alone", 1), (None, 5)]
    left += [("hot", 3)] * 3
    right = [("hot", i) for i in range(5)] + [("cold", 9), ("right only", 1), (None, 7)]
    clicks = spark.createDataFrame(left, "k STRING, click BIGINT")
    views = spark.createDataFrame(right, "k STRING, view BIGINT")

    def counted(pairs):
        rows = pa.array([pairs.num_rows], pa.int64())
        paired = pa.array([pairs["paired"].true_count], pa.int64())
        return pa.RecordBatch.from_arrays([rows, paired], ["rows", "paired"])

    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}):
        result = co_group_apply(
            clicks, views, ["k"], lambda pairs: pairs.drop_columns(["paired"]), "k STRING, click BIGINT, view BIGINT"
        )
        # A NULL key has no partner.
        expected = []
        for key, click in left:
            partners = [view for k, view in right if k == key and k is not None] or [None]
            expected += [(key, click, view) for view in partners]
        assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)
        # A function that counts its rows counts the same ones however they are cut.
        sums = co_group_apply(clicks, views, ["k"], counted, "rows BIGINT, paired BIGINT")
        assert tuple(sums.groupBy().sum("rows", "paired").first()) == (len(expected), len(expected) - 2)


def test_running_state_cuts_a_heavy_null_key(spark):
    rows = [(None if i % 3 else "a", i, f"2024-01-01 00:{i % 60:02d}:{i // 60:02d}") for i in range(150)]
    rows += [(None, 1, None), ("a", 1, None)]
    df = spark.createDataFrame(rows, "key STRING, value INT, t STRING").withColumn("ts", F.col("t").cast("timestamp"))
    for only in ("key IS NULL", "true"):
        some = df.filter(only)
        whole = running_state(some, "key", "value", ["ts", "value"])
        cut = running_state(some, "key", "value", ["ts", "value"], rows_per_task=2)
        assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
