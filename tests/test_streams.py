"""Streams: repeated batches, buckets, late rows, refreshed lookups, options."""

import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changelog import apply_changelog
from tidemark.operators.latest import latest_states
from tidemark.plans.replays import REPLAY_QUERIES
from tidemark.session import list_names, session_conf, shared_base, stream_settings, write_text
from tidemark.sinks import upsert
from tidemark.sinks.jdbc import duplicate_key_statement, merge_statement
from tidemark.sinks.upsert import KEPT_VERSIONS, keyed_table, read_latest, state_table
from tidemark.sources.jdbc import jdbc_read_options
from tidemark.sources.lines import read_lines
from tidemark.sources.topics import parse_json_checked
from tidemark.streaming.asof import asof_join_stream
from tidemark.streaming.changelog import retract_stream
from tidemark.streaming.jobs import JobCounts, JobSettings, counted, read_settings, start_job
from tidemark.streaming.keyed import keyed_map_stream
from tidemark.streaming.lookup import lookup_sink
from tidemark.streaming.membership import (
    CLASSES,
    USERS,
    MembershipStream,
    MembershipWindows,
    membership_windowed_stream,
)
from tidemark.streaming.performance import (
    first_sightings,
    recent_performance_stream,
    streaming_performance_approximate,
)
from tidemark.streaming.routing import Branch, route_sink
from tidemark.streaming.run import Feed, batch_writer, run_available, with_watermark


def tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=str)


def rows(spark, *values, schema="k INT, v STRING, o INT"):
    return spark.createDataFrame(list(values), schema)


class TestKeyedTable:
    @pytest.fixture
    def table(self, spark, folder):
        return keyed_table(spark, folder, "k INT, v STRING, o INT", ["k"], ["o"])

    def test_empty_before_the_first_batch(self, table):
        assert table.read().count() == 0

    def test_latest_in_the_batch_and_across_batches(self, spark, table):
        table.put(rows(spark, (1, "a", 1), (1, "b", 2), (2, "x", 1)), 0)
        table.put(rows(spark, (1, "c", 3), (2, "late", 0)), 1)
        assert tuples(table.read(), "k", "v") == [(1, "c"), (2, "x")]

    def test_a_repeated_batch_has_one_effect(self, spark, table):
        batch = rows(spark, (1, "a", 1))
        for _ in range(3):
            table.put(batch, 0)
        assert table.rows().count() == 1

    def test_old_folders_go_and_the_result_stays(self, spark, table):
        for i in range(5):
            table.put(rows(spark, (1, f"v{i}", i), (10 + i, "only", i)), i)
        assert tuples(table.read(), "k", "v") == [(1, "v4")] + [(10 + i, "only") for i in range(5)]
        assert len(list_names(spark, f"{table.path}/versions")) == KEPT_VERSIONS
        named = set(table.version().values()) | set(table.version(before=4).values())
        assert {n for n in list_names(spark, table.path) if n.startswith("batch-")} == named

    def test_a_batch_of_one_key_touches_one_bucket(self, spark, table):
        table.put(rows(spark, *[(k, "old", 1) for k in range(100)]), 0)
        before = table.version()
        assert len(before) == table.buckets
        read = []
        real = table.rows
        table.rows = lambda buckets=None, before=None: (read.append(buckets), real(buckets, before))[1]
        table.put(rows(spark, (7, "new", 2)), 1)
        assert [len(buckets) for buckets in read] == [1]
        after = table.version()
        assert [b for b in after if after[b] != before[b]] == [str(read[0][0])]
        assert (7, "new") in tuples(real().select("k", "v"))

    def test_a_crash_before_the_switch_loses_nothing(self, spark, table, monkeypatch):
        table.put(rows(spark, (1, "a", 1), (2, "b", 1)), 0)

        def crash(*_):
            raise OSError("lost")

        with monkeypatch.context() as broken:
            broken.setattr(upsert, "write_text", crash)
            with pytest.raises(OSError):
                table.put(rows(spark, (1, "c", 2)), 1)
        assert tuples(table.read(), "k", "v") == [(1, "a"), (2, "b")]
        table.put(rows(spark, (1, "c", 2)), 1)
        assert tuples(table.read(), "k", "v") == [(1, "c"), (2, "b")]


def test_states_of_batches_merge_to_the_latest(spark, folder):
    state = "STRUCT<o0: INT, value: STRING>"
    table = state_table(spark, folder, f"k INT, v {state}, o_min INT, o_max INT", ["k"], ["v"], ["o"])
    for batch_id, batch in enumerate([[(1, "a", 5), (1, None, 9)], [(1, "old", 2)]]):
        table.put(latest_states(rows(spark, *batch), ["k"], ["v"], ["o"], {"o": "o"}), batch_id)
    assert tuples(read_latest(table, ["k"], ["v"], ["o"])) == [(1, "a", 2, 9)]


def test_distinct_counts_stay_exact_over_restarts(spark, folder):
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], "u STRING, t BIGINT, n INT").schema)
    counted = first_sightings(feed.stream(), "u", {"t": "new"}, ["n"])
    result = counted.groupBy("u").agg(F.sum("new").alias("tasks"), F.sum("n").alias("n"))
    table = keyed_table(spark, f"{folder}/out", "u STRING, tasks BIGINT, n BIGINT", ["u"])
    for part in ([("a", 1, 1), ("a", 1, 1), ("b", None, 1)], [("a", 2, 1), ("a", 1, 1)]):
        feed.add(spark.createDataFrame(part, feed.schema))
        run_available(result, table.put, f"{folder}/checkpoint", "update")
    assert tuples(table.read()) == [("a", 2, 4), ("b", 0, 1)]


def test_approximate_counts_run_on_a_stream(spark, folder):
    schema = (
        "user_id STRING, task_id BIGINT, course_id BIGINT, task_type INT, creteria_type INT,"
        " c_time BIGINT, op STRING, proctime TIMESTAMP"
    )
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
    feed.add(spark.createDataFrame([("u", 1, 2, 1, 1, 1, "c", datetime(2024, 1, 1))], schema))
    result = streaming_performance_approximate(feed.stream()).drop("max_proctime")
    table = keyed_table(
        spark, f"{folder}/out", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result.schema), ["user_id"]
    )
    run_available(result, table.put, f"{folder}/checkpoint", "update")
    assert tuples(table.read(), "user_id", "task_count") == [("u", 1)]


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


LEFT, RIGHT = "c STRING, ot TIMESTAMP, o INT", "c STRING, rt TIMESTAMP, r BIGINT"


def asof_steps(spark, folder, steps, **options):
    """The stream's rows after each step, restarted from its checkpoint in between."""
    orders = Feed(spark, f"{folder}/o", spark.createDataFrame([], LEFT).schema)
    rates = Feed(spark, f"{folder}/r", spark.createDataFrame([], RIGHT).schema)
    out = []
    with session_conf(spark, stream_settings()):
        for some_orders, some_rates in steps:
            orders.add(spark.createDataFrame(some_orders, LEFT))
            rates.add(spark.createDataFrame(some_rates, RIGHT))
            result = asof_join_stream(orders.stream(), rates.stream(), ["c"], "ot", "rt", "r", **options)
            run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
            out.append(tuples(spark.read.schema(result.schema).parquet(f"{folder}/out"), "o", "r"))
    return out


@pytest.mark.parametrize("splits", [1, 3])
def test_asof_stream_waits_for_rates_and_keeps_old_ones(spark, folder, splits):
    steps = [
        # The first order is before any rate; the second waits for the next step.
        ([("x", at(1), 1), ("x", at(10), 2)], [("x", at(5), 50)]),
        ([("x", at(20), 3)], [("x", at(9), 90), ("x", at(20), 200), ("x", at(20), 201)]),
        # No newer rate: the one of an earlier step still holds. The last rows close.
        ([("x", at(30), 4), ("end", at(50), 9)], [("end2", at(50), 0)]),
    ]
    out = asof_steps(spark, folder, steps, splits=splits)
    assert out == [[], [(2, 90), (3, 201)], [(2, 90), (3, 201), (4, 201)]]


def test_asof_stream_with_rows_out_of_order_late_and_without_key(spark, folder):
    steps = [
        (
            [("x", at(20), 1), ("x", at(4), 2), (None, at(1), 0), ("x", None, 8)],
            [("x", at(9), 9), ("x", at(2), 2), ("y", None, 1)],
        ),
        ([("x", at(35), 3), ("y", at(40), 4)], [("x", at(18), 18), ("x", at(31), 31)]),
        # Late: the version of 9 is gone. That of 31 is the watermark's own, so that of 18
        # is the newest before it and serves the order of 19.
        ([("x", at(10), 5), ("x", at(19), 6)], []),
        ([("z", at(59), 7)], [("z", at(59), 60)]),
    ]
    out = asof_steps(spark, folder, steps)
    assert out[2] == [(1, 18), (2, 2), (6, 18)]
    assert out[3] == [(1, 18), (2, 2), (3, 31), (6, 18), (7, 60)]


def test_asof_stream_keeps_rows_without_a_version(spark, folder):
    steps = [([("x", at(1), 1), ("x", at(9), 2)], [("x", at(5), 50)]), ([("e", at(59), 9)], [("e2", at(59), 0)])]
    out = asof_steps(spark, folder, steps, how="left")
    assert out[-1] == sorted([(1, None), (2, 50), (9, None)], key=str)


def test_asof_stream_drops_superseded_versions(spark, folder):
    versions = [("x", at(m), m) for m in range(20)]
    asof_steps(spark, folder, [([("x", at(19), 1)], versions), ([("x", at(30), 2)], [("x", at(30), 30)])])
    kept = spark.read.format("statestore").option("stateVarName", "versions").load(f"{folder}/checkpoint")
    # Those of the watermark, and the newest before it.
    assert kept.count() == 2
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{folder}/checkpoint")
    assert waiting.count() == 0


def test_asof_stream_keeps_what_waits_in_chunks(spark, folder):
    orders = [("x", at(i % 50 + 5), None if i == 7 else i) for i in range(2500)]
    rates = [("x", at(2), 2), ("x", at(4), None), ("x", at(30), 30), ("x", at(30), 29)]
    steps = [(orders, rates), ([("e", at(20), 0)], [("e", at(20), 0)]), ([("e", at(59), 0)], [("e2", at(59), 0)])]
    before = asof_steps(spark, folder, steps[:1])[-1]
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{folder}/checkpoint")
    # Rows later than the watermark, minute 30, are held as elements of up to a thousand.
    assert 0 < waiting.count() <= 3
    assert len(before) == 50 * 26
    out = asof_steps(spark, folder, steps[1:])[-1]
    expected = [(o, 30 if t.minute >= 30 else None) for _, t, o in orders]
    assert [row for row in out if row != (0, 0)] == sorted(expected, key=str)


def test_asof_stream_refuses_what_it_cannot_join(spark):
    left, right = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    for bad in ({"how": "right"}, {"splits": 0}):
        with pytest.raises(ValueError):
            asof_join_stream(left, right, ["c"], "ot", "rt", "r", **bad)
    with pytest.raises(ValueError, match="o"):
        asof_join_stream(left, right.withColumnRenamed("r", "o"), ["c"], "ot", "rt", "o")


def test_retracts_come_for_each_record(spark, folder):
    schema = "k STRING, v STRING, n INT, o INT"
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
    with session_conf(spark, stream_settings()):
        result = retract_stream(feed.stream(), ["k"], ["v", "n"], ["o"])
        parts = [
            # Two changes of a key in one micro-batch give both.
            [("a", "one", None, 1), ("a", "two", 5, 2), ("b", None, None, 1)],
            # NULL changes nothing, nor does the same value.
            [("a", None, None, 3), ("a", "two", 5, 4), ("a", "three", 6, 5), (None, "x", 1, 1)],
        ]
        for part in parts:
            feed.add(spark.createDataFrame(part, schema))
            run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
    changes = spark.read.parquet(f"{folder}/out")
    assert tuples(changes.filter("k = 'a'"), "o", "is_add", "v", "n") == [
        (1, True, "one", None),
        (2, False, "one", None),
        (2, True, "two", 5),
        (5, False, "two", 5),
        (5, True, "three", 6),
    ]
    nothing = spark.createDataFrame([], "k STRING, v STRING, n INT")
    folded = apply_changelog(nothing, changes.drop("batch_id", "o"))
    assert tuples(folded) == sorted([("a", "three", 6), ("b", None, None), (None, "x", 1)], key=str)


class TestPanes:
    SCHEMA = (
        "user_id STRING, task_id BIGINT, course_id BIGINT, task_type INT, creteria_type INT,"
        " c_time BIGINT, op STRING, proctime TIMESTAMP"
    )

    def event(self, second, task, course=1):
        return ("u", task, course, 1, 2, 3, "c", datetime(2024, 1, 1, 0, 0, 0) + timedelta(seconds=second))

    def windows(self, spark, folder, parts, slide, panes):
        feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], self.SCHEMA).schema)
        with session_conf(spark, stream_settings()):
            result = recent_performance_stream(with_watermark(feed.stream(), "proctime"), slide, panes)
            for part in parts:
                feed.add(spark.createDataFrame(part, self.SCHEMA))
                run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
        found = spark.read.parquet(f"{folder}/out").filter("user_id = 'u'")
        start = datetime(2024, 1, 1)
        return result, {
            int((r["until"] - start).total_seconds()): (r["task_count"], r["course_count"], r["sum_create"])
            for r in found.collect()
        }

    def expected(self, events, slide, panes):
        out = {}
        last = max(int((e[-1] - datetime(2024, 1, 1)).total_seconds()) for e in events)
        for end in range(slide, last + slide * panes + 1, slide):
            held = [
                e for e in events
                if end - slide * panes <= (e[-1] - datetime(2024, 1, 1)).total_seconds() < end
            ]
            if held:
                tasks = {e[1] for e in held} - {None}
                out[end] = (len(tasks), len({e[2] for e in held}), len(held))
        return out

    def test_sixty_panes_a_window(self, spark, folder):
        rng = random.Random(4)
        seconds = sorted(rng.randrange(300) for _ in range(40))
        events = [self.event(s, rng.choice([1, 2, 3, None]), rng.randrange(3)) for s in seconds]
        closing = [("end", None, None, 1, 1, 1, "c", datetime(2030, 1, 1))]
        _, found = self.windows(spark, folder, [events[:15], events[15:], closing], 1, 60)
        assert found == self.expected(events, 1, 60)

    def test_events_are_not_copied_before_they_are_summed(self, spark, folder):
        events = [self.event(s, 1) for s in range(10)]
        result, _ = self.windows(spark, folder, [events], 5, 12)
        plan = result._jdf.queryExecution().analyzed().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-~"))
        expands = [i for i, line in enumerate(plan) if "Expand" in line]
        assert expands
        for i in expands:  # what is copied has been summed: an aggregate is below
            below = [line for line in plan[i + 1 :] if depth(line) > depth(plan[i])]
            assert any("Aggregate" in line for line in below)
        sources = sum("StreamingRelation" in line for line in plan)
        assert sum("Aggregate" in line for line in plan) == sources + 1

    def test_values_are_counted_without_a_python_process_per_key(self, spark, folder):
        events = [self.event(s, task) for s, task in ((1, 7), (6, 7), (7, None), (12, 8))]
        closing = [("end", None, None, 1, 1, 1, "c", datetime(2030, 1, 1))]
        result, found = self.windows(spark, folder, [events[:2], events[2:], closing], 5, 2)
        assert "TransformWithState" not in result._jdf.queryExecution().analyzed().toString()
        assert found == self.expected(events, 5, 2)


def test_recent_performance_leaves_no_store_open(spark, folder):
    # "props" holds the task and the course, "k" and "k" % 10.
    events = [(e, datetime(2024, 1, 1 + e % 28), e % 3, "signup", f'{{"k": {e % 5}}}') for e in range(60)]
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING"
    spark.createDataFrame(events, schema).write.parquet(f"{folder}/events.parquet")
    memory = spark._jvm.org.apache.spark.sql.execution.streaming.state.RocksDBMemoryManager
    before = memory.getNumRocksDBInstances(False)
    found = REPLAY_QUERIES["recent_performance_replay"](spark, folder)
    # Stores of earlier streams may go meanwhile.
    assert memory.getNumRocksDBInstances(False) <= before
    assert memory.getNumRocksDBInstances(True) == 0
    # Every event is in two windows of a day.
    assert found.agg(F.sum("sum_create")).first()[0] == 2 * len(events)


def test_membership_windows_come_with_the_watermark(spark, folder):
    users = Feed(spark, f"{folder}/u", spark.createDataFrame([], "uid BIGINT, name STRING, age INT, position STRING").schema)
    classes = Feed(spark, f"{folder}/c", spark.createDataFrame([], "cid BIGINT, cname STRING, position STRING").schema)
    links = Feed(
        spark, f"{folder}/l", spark.createDataFrame([], "uid BIGINT, cid BIGINT, utype STRING, c_time TIMESTAMP, position STRING").schema
    )
    users.add(spark.createDataFrame([(1, "ann", 20, "1"), (1, "anna", None, "2")], users.schema))
    classes.add(spark.createDataFrame([(5, "math", "1")], classes.schema))
    seen = []
    with session_conf(spark, stream_settings()):
        result = membership_windowed_stream(
            users.stream(), classes.stream(), with_watermark(links.stream(), "c_time"), size="10 minutes"
        )
        parts = [
            [(1, 5, "s", at(1), "1"), (1, 5, "t", at(9), "2"), (2, 5, "x", at(3), "3")],
            [(1, 5, "late", at(2), "4"), (1, 5, "v", at(15), "5")],
            [(1, 6, "none", at(50), "6")],
        ]
        for part in parts:
            links.add(spark.createDataFrame(part, links.schema))
            run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
            written = spark.read.schema(result.schema).parquet(f"{folder}/out")
            seen.append(tuples(written, "name", "age", "utype"))
    # The link of minute 2 came after that of minute 9.
    assert seen == [[], [("anna", 20, "t")], [("anna", 20, "t"), ("anna", 20, "v")]]


def test_closed_windows_look_users_and_classes_up(spark, folder):
    state = MembershipWindows(spark, f"{folder}/state")
    users, classes = "uid BIGINT, name STRING, age INT, position STRING", "cid BIGINT, cname STRING, position STRING"
    known = [(1, "ann", 20, "1"), (1, "anna", None, "2"), (None, "nobody", 1, "3")]
    state.put(USERS)(spark.createDataFrame(known, users), 0)
    state.put(CLASSES)(spark.createDataFrame([(5, "math", "1")], classes), 0)
    schema = "uid BIGINT, cid BIGINT, utype STRING, c_time TIMESTAMP, position STRING"
    feed = Feed(spark, f"{folder}/l", spark.createDataFrame([], schema).schema)
    steps = [
        [(1, 5, "s", at(1), "1"), (1, 5, "t", at(9), "2"), (2, 5, "x", at(3), "3"), (None, 5, "n", at(4), "4")],
        # The watermark has passed minute 2, but its window is still open.
        [(1, 5, "w", at(2), "4"), (1, 5, "v", at(15), "5")],
        [(1, 6, "none", at(50), "6"), (1, 5, "late", at(3), "7")],
    ]
    staged = [(*row, part) for part, step in enumerate(steps) for row in step]
    feed.stage(spark.createDataFrame(staged, f"{schema}, part INT"), F.col("part"))
    seen = []
    with session_conf(spark, stream_settings()):
        result = state.windows(with_watermark(feed.stream(), "c_time"), size="10 minutes")
        plan = result._jdf.queryExecution().analyzed().toString()
        assert "Join" not in plan and plan.count("Aggregate") == 1
        for part in (0, 1, 7, 2):  # there is no stretch 7
            feed.release(part)
            run_available(result, state.sink(batch_writer(f"{folder}/out")), f"{folder}/checkpoint")
            seen.append(tuples(spark.read.parquet(f"{folder}/out"), "name", "age", "utype") if part else [])
            if part == 1:  # too late for the first window, in time for the second
                state.put(USERS)(spark.createDataFrame([(1, "annie", 21, "3")], users), 1)
    assert seen == [[], [("anna", 20, "w")], [("anna", 20, "w")], [("anna", 20, "w"), ("annie", 21, "v")]]


def test_closed_windows_are_joined_by_measure_and_not_sent_to_the_driver(spark, folder):
    state = MembershipWindows(spark, f"{folder}/state")
    users, classes = "uid BIGINT, name STRING, age INT, position STRING", "cid BIGINT, cname STRING, position STRING"
    state.put(USERS)(spark.createDataFrame([(u, f"u{u}", u, "1") for u in range(20)], users), 0)
    state.put(CLASSES)(spark.createDataFrame([(5, "math", "1")], classes), 0)
    schema = "uid BIGINT, cid BIGINT, utype STRING, c_time TIMESTAMP, position STRING"
    feed = Feed(spark, f"{folder}/l", spark.createDataFrame([], schema).schema)
    plans, limits, write = [], [], batch_writer(f"{folder}/out")

    def record(found, batch_id):
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        write(found, batch_id)

    sink = state.sink(record)

    def on_batch(closed, batch_id):
        limit = "spark.sql.autoBroadcastJoinThreshold"
        before = closed.sparkSession.conf.get(limit)
        sink(closed, batch_id)
        limits.append((before, closed.sparkSession.conf.get(limit)))

    links = [(u % 21, 5, f"t{u}", at(1), str(u).zfill(4)) for u in range(1000)]
    with session_conf(spark, stream_settings()):
        result = state.windows(with_watermark(feed.stream(), "c_time"), size="10 minutes")
        for part in (links, [(1, 6, "none", at(50), "6")]):
            feed.add(spark.createDataFrame(part, schema))
            run_available(result, on_batch, f"{folder}/checkpoint")
    # A micro-batch without input brings the windows: its estimated size says nothing of them.
    assert plans and all("AdaptiveSparkPlan" in plan and "Broadcast" not in plan for plan in plans)
    assert all(before == after for before, after in limits)
    expected = [(u, f"u{u}", f"t{max(n for n in range(1000) if n % 21 == u)}") for u in range(20)]
    assert tuples(spark.read.parquet(f"{folder}/out"), "uid", "name", "utype") == sorted(expected, key=str)


def test_keyed_map_returns_a_row_for_each_row(spark, folder):
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], "k STRING, v INT").schema)

    def running(state, chunk):
        total = (state or (0,))[0] + chunk["v"].cumsum()
        return (int(total.iloc[-1]),), chunk.assign(total=total)[["k", "v", "total"]]

    with session_conf(spark, stream_settings()):
        result = keyed_map_stream(feed.stream(), "k", running, "total LONG", "k STRING, v INT, total LONG")
        for part in ([("a", 1), ("b", 5)], [("a", 2), ("a", 2)]):
            feed.add(spark.createDataFrame(part, feed.schema).coalesce(1))
            run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
    assert tuples(spark.read.parquet(f"{folder}/out"), "k", "total") == [("a", 1), ("a", 3), ("a", 5), ("b", 5)]


def test_keyed_map_starts_from_a_table_once(spark, folder):
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], "k STRING, v INT").schema)
    start = spark.createDataFrame([("a", 10), ("c", 7)], "k STRING, total BIGINT")

    def running(state, chunk):
        total = (state or (0,))[0] + chunk["v"].cumsum()
        return (int(total.iloc[-1]),), chunk.assign(total=total)[["k", "v", "total"]]

    with session_conf(spark, stream_settings()):
        result = keyed_map_stream(feed.stream(), "k", running, "total LONG", "k STRING, v INT, total LONG", start)
        for part in ([("a", 1), ("b", 5)], [("a", 2)]):
            feed.add(spark.createDataFrame(part, feed.schema))
            run_available(result, batch_writer(f"{folder}/out"), f"{folder}/checkpoint")
    assert tuples(spark.read.parquet(f"{folder}/out"), "k", "total") == [("a", 11), ("a", 13), ("b", 5)]
    # The state as Spark's own reader gives it, also for a key without rows.
    held = spark.read.format("statestore").option("stateVarName", "state").load(f"{folder}/checkpoint")
    assert sorted((r["key"][0], r["value"][0]) for r in held.collect()) == [("a", 13), ("b", 5), ("c", 7)]


class TestRouteSink:
    def feed(self, spark, folder):
        return Feed(spark, f"{folder}/in", spark.createDataFrame([], "t STRING, v INT").schema)

    def test_a_failing_sink_repeats_the_others_in_effect_only(self, spark, folder):
        feed, calls = self.feed(spark, folder), []

        def fragile(rows, batch_id):
            calls.append(batch_id)
            if len(calls) == 2:
                raise OSError("lost")
            batch_writer(f"{folder}/b")(rows, batch_id)

        first = []

        def noted(rows, batch_id):
            first.append(batch_id)
            batch_writer(f"{folder}/a")(rows, batch_id)

        sink = route_sink([Branch("a", F.col("t") == "a", noted), Branch("b", F.col("t") != "a", fragile), Branch("all", None, batch_writer(f"{folder}/all"))])
        feed.add(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], feed.schema))
        run_available(feed.stream(), sink, f"{folder}/checkpoint")
        feed.add(spark.createDataFrame([("a", 4), ("b", 5)], feed.schema))
        with pytest.raises(Exception, match="lost"):
            run_available(feed.stream(), sink, f"{folder}/checkpoint")
        run_available(feed.stream(), sink, f"{folder}/checkpoint")
        assert first == [0, 1, 1] and calls == [0, 1, 1]
        values = {name: [v for (v,) in tuples(spark.read.parquet(f"{folder}/{name}"), "v")] for name in ("a", "b", "all")}
        assert values == {"a": [1, 4], "b": [2, 5], "all": [1, 2, 3, 4, 5]}

    def test_a_micro_batch_is_read_once(self, spark, folder):
        rows = spark.createDataFrame([("a", 1)], "t STRING, v INT")
        plans = []
        sink = route_sink([Branch(n, None, lambda df, _: plans.append(df._jdf.queryExecution().toString())) for n in "xy"])
        sink(rows, 0)
        assert all("InMemoryRelation" in plan for plan in plans)
        assert not rows.is_cached

    def test_names_are_checked(self):
        for bad in ([], [Branch("x", None, print), Branch("x", None, print)]):
            with pytest.raises(ValueError):
                route_sink(bad)


class TestJobs:
    def test_settings_come_from_a_file(self, spark, folder):
        write_text(spark, f"{folder}/conf/a", "# comment\n\ncheckpoint.dir = /x=y \ncheckpoint.interval=250\n!no\nother=1\n")
        assert read_settings(spark, f"{folder}/conf/a") == JobSettings("/x=y", 250)
        write_text(spark, f"{folder}/conf/b", "checkpoint.dir=/x")
        assert read_settings(spark, f"{folder}/conf/b").trigger_millis == 5000
        for text in ("checkpoint.interval=5", "checkpoint.dir=/x\ncheckpoint.interval=0", "nothing"):
            name = f"{folder}/conf/{len(text)}-bad"
            write_text(spark, name, text)
            with pytest.raises(ValueError):
                read_settings(spark, name)

    def test_a_stopped_job_goes_on_and_counts_late_and_corrupt_rows(self, spark, folder):
        schema = spark.createDataFrame([], "value STRING, ts TIMESTAMP").schema
        feed = Feed(spark, f"{folder}/in", schema)
        counts = JobCounts("job")
        spark.streams.addListener(counts)
        try:
            parts = [
                [('{"k": 1}', at(1)), ("broken", at(2)), ('{"k": 2}', at(30))],
                # Late by half an hour, and one that moves the watermark.
                [('{"k": 3}', at(0)), ('{"k": "x"}', at(31)), ('{"k": 4}', at(59))],
                [],
            ]
            for part in parts:
                if part:
                    feed.add(spark.createDataFrame(part, schema))
                rows = parse_json_checked(with_watermark(feed.stream(), "ts"), "k INT", keep=("ts",), mode="marked")
                rows = counted(rows, "parsed", corrupt=F.col("_corrupt").isNotNull()).filter("_corrupt IS NULL")
                result = rows.groupBy(F.window("ts", "10 minutes")).agg(F.sum("k").alias("k"))
                job = start_job(result, batch_writer(f"{folder}/out"), JobSettings(f"{folder}/checkpoint", 100), "job")
                try:
                    job.processAllAvailable()
                finally:
                    job.stop()
        finally:
            deadline = time.time() + 20
            while counts.counts["input"] < 6 and time.time() < deadline:
                time.sleep(0.2)
            spark.streams.removeListener(counts)
        assert counts.counts["input"] == counts.counts["parsed.rows"] == 6
        assert counts.counts["parsed.corrupt"] == 2
        assert counts.counts["late"] == 1
        assert tuples(spark.read.parquet(f"{folder}/out"), "k") == [(1,), (2,)]


def test_lookup_sees_the_table_of_the_moment(spark, folder):
    feed = Feed(spark, f"{folder}/in", spark.createDataFrame([], "id INT, ref INT").schema)
    dim = {"rows": [(7, "old")]}
    sink = lookup_sink(
        lambda: spark.createDataFrame(dim["rows"], "key INT, name STRING"),
        "ref",
        "key",
        {"name": "name"},
        batch_writer(f"{folder}/out"),
    )
    feed.add(spark.createDataFrame([(1, 7)], feed.schema))
    run_available(feed.stream(), sink, f"{folder}/checkpoint")
    dim["rows"] = [(7, "new")]
    feed.add(spark.createDataFrame([(2, 7)], feed.schema))
    run_available(feed.stream(), sink, f"{folder}/checkpoint")
    assert tuples(spark.read.parquet(f"{folder}/out"), "id", "name") == [(1, "old"), (2, "new")]


def test_membership_changes_per_batch_and_repeated_batch(spark, folder):
    state = MembershipStream(spark, folder)

    def messages(*values):
        return spark.createDataFrame(list(values), "topic STRING, value STRING, position STRING")

    first = messages(
        ("test_user", '{"uid":1,"name":"ann","age":"20"}', "1"),
        ("test_class", '{"cid":"5","cname":"math"}', "1"),
        ("test_class_user", '{"uid":1,"cid":5,"utype":"s"}', "1"),
    )
    second = messages(
        ("test_user", '{"uid":1,"name":"anna","age":null}', "2"),
        ("test_class_user", '{"uid":2,"cid":5,"utype":"t"}', "2"),
    )
    state.on_batch(first, 0)
    for _ in range(2):
        state.on_batch(second, 1)
    changes = spark.read.parquet(state.changes_path)
    assert tuples(changes, "batch_id", "is_add", "name", "age") == [
        (0, True, "ann", 20),
        (1, False, "ann", 20),
        (1, True, "anna", 20),
    ]
    assert tuples(state.current()) == [(1, 5, "anna", 20, "math", "s")]


def test_membership_keeps_links_once_and_finds_those_of_a_changed_class(spark, folder):
    state = MembershipStream(spark, folder, buckets=4)

    def message(topic, position, **fields):
        return (topic, json.dumps(fields), position)

    users = [message("test_user", "1", uid=u, name=f"u{u}", age=u) for u in range(12)]
    links = [message("test_class_user", "1", uid=u, cid=u % 2, utype="s") for u in range(12)]
    classes = [message("test_class", "1", cid=str(c), cname=f"c{c}") for c in range(2)]
    batches = [
        [*users, *classes, *links[:10], ("test_class_user", "broken", "1"), ("other", "{}", "9")],
        # A class of users in all buckets; a field that its topic does not have.
        [message("test_class", "2", cid="1", cname="one", name="no"), *links[10:11]],
        # Nothing new, an older value, a known link without a value, and a new name.
        [message("test_user", "2", uid=3, name="u3"), message("test_user", "0", uid=4, name="old")],
        [message("test_class_user", "2", uid=5, cid=1), message("test_user", "3", uid=6, name="six"), *links[11:]],
    ]
    counts = []
    for i, batch in enumerate(batches):
        state.on_batch(spark.createDataFrame(batch, "topic STRING, value STRING, position STRING"), i)
        changes = spark.read.parquet(state.changes_path)
        counts.append((changes.filter("NOT is_add").count(), changes.count()))
        nothing = state.current().limit(0)
        assert tuples(apply_changelog(nothing, changes.drop("batch_id"))) == tuples(state.current())
    assert counts == [(0, 10), (5, 21), (5, 21), (6, 24)]
    assert sorted(list_names(spark, folder)) == ["changes", "test_class", "test_class_user", "test_user"]


def test_text_lines_stream(spark, folder):
    spark.createDataFrame([("a,1",), ("b,2",)], "value STRING").write.text(f"{folder}/in")
    run_available(
        read_lines(spark, f"{folder}/in", stream=True),
        batch_writer(f"{folder}/out"),
        f"{folder}/checkpoint",
    )
    assert tuples(spark.read.parquet(f"{folder}/out"), "value") == [("a,1",), ("b,2",)]


def test_session_options_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with session_conf(spark, {name: "3", "spark.tidemark.probe": "x"}):
        assert spark.conf.get(name) == "3"
    assert spark.conf.get(name) == before
    assert spark.conf.get("spark.tidemark.probe", None) is None


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_base(spark) == configured


class TestJdbc:
    def test_merge_statement(self):
        assert merge_statement("t1", "s1", ["id", "name"], ["id"]) == (
            'MERGE INTO t1 t USING s1 s ON t."id" = s."id"'
            ' WHEN MATCHED THEN UPDATE SET "name" = s."name"'
            ' WHEN NOT MATCHED THEN INSERT ("id", "name") VALUES (s."id", s."name")'
        )
        with pytest.raises(ValueError):
            merge_statement("t1", "s1", ["id"], ["other"])

    def test_duplicate_key_statement(self):
        assert duplicate_key_statement("t1", "s1", ["id", "name"], ["id"]) == (
            "INSERT INTO t1 (`id`, `name`) SELECT `id`, `name` FROM s1"
            " ON DUPLICATE KEY UPDATE `name` = VALUES(`name`)"
        )
        with pytest.raises(ValueError):
            duplicate_key_statement("t1", "s1", ["id"], [])

    def test_read_in_ranges(self):
        options = jdbc_read_options("jdbc:x", "t", "id INT", partition=("id", 0, 100, 8))
        assert options["numPartitions"] == "8"
        assert options["fetchsize"] == "100"
        with pytest.raises(ValueError):
            jdbc_read_options("jdbc:x", "t", "id INT", partition=("id", 5, 5, 8))
