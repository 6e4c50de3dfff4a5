"""Hand-written cases for what the operators promise at the edges."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.cdc import flatten_changes, flatten_changes_by_presence
from tidemark.functions.shape import align_to, product, rename
from tidemark.functions.times import epoch_ms_to_timestamp, local_text_to_epoch_ms
from tidemark.operators.asof import asof_join
from tidemark.operators.changelog import apply_changelog, changelog_diff
from tidemark.operators.latest import latest_by_key, latest_rows
from tidemark.operators.lookup import (
    lookup_by_row_key,
    lookup_in_cells,
    lookup_join,
    performance_by_ref,
)
from tidemark.operators.performance import task_performance
from tidemark.operators.routing import parse_branch, route
from tidemark.operators.windowjoin import window_join
from tidemark.sinks.search import documents
from tidemark.sinks.widecolumn import WriteOptions, apply_to_cells, to_cells
from tidemark.sources.catalog import read_table, register_parquet
from tidemark.sources.lines import parse_lines
from tidemark.sources.topics import (
    parse_json,
    parse_json_checked,
    topic_options,
    unwrap_envelope,
    unwrap_topic_envelope,
)
from tidemark.sources.widecolumn import read_rows


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def tuples(df, *names):
    return sorted(
        (tuple(row) for row in df.select(*(names or df.columns)).collect()), key=str
    )


def flat(spark, *values):
    df = texts(spark, *values).withColumn("proctime", F.lit("2024-01-01").cast("timestamp"))
    return flatten_changes(parse_json(df, schemas.CHANGE_EVENT, keep=("proctime",)))


BEFORE = '{"USER_ID":"b","TASK_ID":1,"COURSE_ID":2,"TASK_TYPE":3,"CRETERIA_TYPE":4,"C_TIME":5}'


class TestChangeEvents:
    def test_delete_takes_every_field_from_before(self, spark):
        row = flat(spark, f'{{"before":{BEFORE},"after":null,"op":"d","ts_ms":1000}}').first()
        assert tuple(row)[:7] == ("b", 1, 2, 3, 4, 5, "d")

    def test_fields_fall_back_one_by_one(self, spark):
        after = '{"USER_ID":"a","TASK_ID":null,"COURSE_ID":9}'
        row = flat(spark, f'{{"before":{BEFORE},"after":{after},"op":"u","ts_ms":1}}').first()
        assert tuple(row)[:6] == ("a", 1, 9, 3, 4, 5)

    def test_presence_keeps_a_json_null(self, spark):
        after = '{"USER_ID":"a","TASK_ID":null,"COURSE_ID":"9"}'
        message = f'{{"before":{BEFORE},"after":{after},"op":"u","ts_ms":"7"}}'
        row = flatten_changes_by_presence(texts(spark, message)).first()
        assert tuple(row) == ("a", None, 9, 3, 4, 5, "u", 7)

    @pytest.mark.parametrize("after", ["", '"after":null,'])
    def test_presence_takes_before_without_after(self, spark, after):
        message = f'{{"before":{BEFORE},{after}"op":"d","ts_ms":7}}'
        row = flatten_changes_by_presence(texts(spark, message)).first()
        assert tuple(row)[:6] == ("b", 1, 2, 3, 4, 5)

    def test_milliseconds_are_cut_off(self, spark):
        df = spark.range(1).select(
            epoch_ms_to_timestamp(F.lit(1700000000999).cast("bigint")).alias("t")
        )
        assert df.first()["t"] == datetime(2023, 11, 14, 22, 13, 20)

    def test_null_op_counts_in_neither_sum_and_updates_count_again(self, spark):
        messages = [
            f'{{"after":{BEFORE},"op":{op},"ts_ms":1}}' for op in ('"c"', '"u"', '"u"', "null")
        ]
        row = task_performance(flat(spark, *messages)).first()
        assert (row.sum_create, row.sum_other) == (1, 2)
        assert (row.task_count, row.sum_time) == (1, 20)


class TestParsing:
    def test_envelopes_without_a_value_are_dropped(self, spark):
        df = unwrap_envelope(texts(spark, '{"value":"{}"}', '{"value":null}', "{}"))
        assert tuples(df) == [("{}",)]

    def test_topic_envelope(self, spark):
        df = unwrap_topic_envelope(texts(spark, '{"topic":"t","value":"x"}', '{"topic":"t"}'))
        assert tuples(df) == [("t", "x")]

    def test_quoted_numbers_need_lenient(self, spark):
        df = texts(spark, '{"uid":"7","name":"n","age":8}')
        assert tuples(parse_json(df, schemas.USER)) == [(None, "n", 8)]
        assert tuples(parse_branch(df, schemas.USER)) == [(7, "n", 8)]

    def test_bad_lines_are_set_apart(self, spark):
        parsed = parse_lines(texts(spark, "k,5", "k,x", "k", "k,6,more"), schemas.KEY_VALUE_LINE)
        assert tuples(parsed.rows) == [("k", 5), ("k", 6)]
        assert tuples(parsed.corrupt) == [("k",), ("k,x",)]

    def test_failfast_raises(self, spark):
        rows = parse_lines(texts(spark, "k,5", "k,x"), schemas.KEY_VALUE_LINE, mode="failfast")
        with pytest.raises(Exception, match="bad line"):
            rows.collect()

    def test_local_text_is_read_at_its_zone(self, spark):
        df = texts(spark, "2024-01-01 08:00:00").select(
            local_text_to_epoch_ms(F.col("value")).alias("ms")
        )
        assert df.first()["ms"] == 1704067200000

    def test_start_positions(self):
        options = topic_options("host:1", ["a", "b"], "group-offsets", "earliest")
        assert options["subscribe"] == "a,b"
        assert options["startingOffsets"] == "earliest"
        with pytest.raises(ValueError):
            topic_options("host:1", ["a"], "yesterday")

    def test_route_may_repeat_and_lose_rows(self, spark):
        df = spark.range(4)
        parts = route(df, {"low": F.col("id") < 2, "one": F.col("id") == 1, "all": None})
        assert {name: part.count() for name, part in parts.items()} == {
            "low": 2,
            "one": 1,
            "all": 4,
        }


class TestShape:
    def test_product_does_not_overflow(self, spark):
        df = spark.range(1).select(product(F.lit(2**31 - 1), F.lit(10)).alias("p"))
        assert df.first()["p"] == (2**31 - 1) * 10

    def test_align_goes_by_name(self, spark):
        df = spark.sql("SELECT 'n' AS name, 5L AS age, '3' AS uid")
        assert align_to(df, schemas.USER).dtypes == [
            ("uid", "bigint"),
            ("name", "string"),
            ("age", "int"),
        ]
        with pytest.raises(ValueError):
            align_to(df.drop("age"), schemas.USER)

    def test_rename_checks_the_names(self, spark):
        with pytest.raises(ValueError):
            rename(spark.range(1), {"nope": "x"})


class TestLatest:
    def test_newest_null_is_skipped_per_column(self, spark):
        df = spark.createDataFrame(
            [(1, 1, "a", 10), (1, 2, "b", None), (1, 3, None, None)],
            "k INT, o INT, x STRING, y INT",
        )
        assert tuples(latest_by_key(df, ["k"], ["x", "y"], ["o"])) == [(1, "b", 10)]
        assert tuples(latest_rows(df, ["k"], ["o"])) == [(1, 3, None, None)]

    def test_an_order_is_required(self, spark):
        with pytest.raises(ValueError):
            latest_by_key(spark.range(1), ["id"], [], [])


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


class TestAsOf:
    @pytest.fixture
    def sides(self, spark):
        orders = spark.createDataFrame(
            [("EUR", at(1), 1), ("EUR", at(5), 2), ("EUR", at(9), 3), ("USD", at(9), 4)]
            + [(None, at(9), 5)],
            "currency STRING, o_time TIMESTAMP, amount INT",
        )
        rates = spark.createDataFrame(
            [("EUR", at(5), 100, 1), ("EUR", at(5), 101, 2), ("EUR", at(7), 102, 3)]
            + [(None, at(1), 999, 4)],
            "currency STRING, r_time TIMESTAMP, rate INT, seq INT",
        )
        return orders, rates

    def test_same_time_applies_later_arrival_wins_and_early_rows_go(self, sides):
        joined = asof_join(*sides, ["currency"], "o_time", "r_time", ["seq"])
        assert tuples(joined, "amount", "rate") == [(2, 101), (3, 102)]

    @pytest.mark.parametrize("rows_per_task", [1, 1000])
    def test_left_keeps_the_unanswered(self, sides, rows_per_task):
        joined = asof_join(
            *sides, ["currency"], "o_time", "r_time", ["seq"], "left", rows_per_task
        )
        assert tuples(joined, "amount", "rate") == [
            (1, None),
            (2, 101),
            (3, 102),
            (4, None),
            (5, None),
        ]


class TestWindowJoin:
    def test_left_keeps_rows_without_partner(self, spark):
        left = spark.createDataFrame(
            [(1, at(0), "a"), (1, at(20), "b"), (2, at(0), "c")], "k INT, t TIMESTAMP, x STRING"
        )
        right = spark.createDataFrame(
            [(1, at(9), "p"), (1, at(8), "q"), (3, at(0), "r")], "k INT, t TIMESTAMP, y STRING"
        )
        inner = window_join(left, right, ["k"], "t", "10 minutes")
        assert tuples(inner, "x", "y") == [("a", "p"), ("a", "q")]
        for splits in (1, 3):
            outer = window_join(left, right, ["k"], "t", "10 minutes", "left", splits)
            assert tuples(outer, "x", "y") == [
                ("a", "p"),
                ("a", "q"),
                ("b", None),
                ("c", None),
            ]
        ends = {row.window_end for row in inner.collect()}
        assert ends == {at(10)}


class TestLookup:
    def test_null_missing_and_repeated_keys(self, spark):
        rows = spark.createDataFrame([(1, None), (2, 7), (3, 8)], "id INT, ref INT")
        dim = spark.createDataFrame([(7, "x"), (7, "y"), (None, "z")], "key INT, name STRING")
        joined = lookup_join(rows, dim, "ref", "key", "left", {"name": "name"})
        assert tuples(joined, "id", "name") == [(1, None), (2, "x"), (2, "y"), (3, None)]
        inner = lookup_join(rows, dim, "ref", "key", "inner", {"name": "name"})
        assert tuples(inner, "id", "name") == [(2, "x"), (2, "y")]

    def test_only_the_row_key_looks_up(self, spark):
        rows = spark.createDataFrame([("u1",)], "uid STRING")
        wide = spark.sql("SELECT 'u1' AS rowkey, named_struct('a', 'x') AS info")
        found = lookup_by_row_key(rows, wide, "uid", ["rowkey"], {"a": "info.a"})
        assert tuples(found) == [("u1", "x")]
        for keys in ([], ["rowkey", "info"], ["info"]):
            with pytest.raises(ValueError):
                lookup_by_row_key(rows, wide, "uid", keys, {"a": "info.a"})


class TestChangelog:
    def test_equal_rows_give_nothing(self, spark):
        before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k INT, v STRING")
        after = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "k INT, v STRING")
        changes = changelog_diff(before, after, ["k"])
        assert tuples(changes) == [(False, 2, "b"), (True, 2, "c"), (True, 4, "d")]
        assert tuples(apply_changelog(before, changes)) == tuples(after)

    def test_copies_are_counted(self, spark):
        table = spark.createDataFrame([(1,), (1,)], "k INT")
        changes = spark.createDataFrame([(True, 1), (False, 1), (True, 2)], "is_add BOOLEAN, k INT")
        assert tuples(apply_changelog(table, changes)) == [(1,), (1,), (2,)]


class TestWideColumn:
    def test_newest_version_and_requested_families_only(self, spark):
        cells = spark.createDataFrame(
            [
                ("r", "info", "a", "old", 1),
                ("r", "info", "a", "new", 2),
                ("r", "info", "b", "5", 1),
                ("r", "other", "c", "x", 1),
                ("s", "other", "c", "x", 1),
            ],
            schemas.CELLS,
        )
        schema = "rowkey STRING, info STRUCT<a: STRING, b: INT>, other STRUCT<c: STRING>"
        rows = read_rows(cells, schema, ["info"])
        assert rows.columns == ["rowkey", "info"]
        assert tuples(rows, "rowkey", "info.a", "info.b") == [("r", "new", 5)]

    def test_layout_needs_one_key(self, spark):
        cells = spark.createDataFrame([], schemas.CELLS)
        for schema in ("info STRUCT<a: STRING>", "r STRING, q STRING, i STRUCT<a: STRING>", "r INT"):
            with pytest.raises(ValueError):
                read_rows(cells, schema)

    def test_retract_drops_the_row_and_add_sets_it(self, spark):
        rows = spark.sql(
            "SELECT rowkey, named_struct('a', rowkey) AS info FROM VALUES ('r'), ('s'), ('t') AS v(rowkey)"
        )
        cells = to_cells(rows, F.lit(1))
        changes = spark.sql(
            "SELECT rowkey, named_struct('a', a) AS info, is_add FROM VALUES"
            " ('r', 'r', false), ('s', 's', false), ('s', 'S', true) AS v(rowkey, a, is_add)"
        )
        after = apply_to_cells(cells, changes, F.lit(2))
        assert tuples(after, "rowkey", "value", "version") == [("s", "S", 2), ("t", "t", 1)]

    def test_option_limits(self):
        WriteOptions("t", "q", flush_bytes=1_048_576, flush_rows=1, flush_millis=1)
        for wrong in (
            {"flush_bytes": 1_048_575},
            {"flush_rows": 0},
            {"flush_millis": 0},
            {"node_parent": ""},
        ):
            with pytest.raises(ValueError):
                WriteOptions("t", "q", **wrong)
        with pytest.raises(ValueError):
            WriteOptions("", "q")


def test_document_needs_its_key(spark):
    df = spark.createDataFrame([("u", 1), (None, 2)], "user_id STRING, n INT")
    assert documents(df.filter("n = 1"), ["user_id"]).first().doc_id == "u"
    with pytest.raises(Exception, match="whole key"):
        documents(df, ["user_id"]).collect()


class TestBrokenRecords:
    MESSAGES = ['{"id": 1, "n": 5}', '{"id": 2}', '{"id": 3, "n": "x"}', '{"id": 4', "", None, "[]", '{"id": null}']

    def test_good_and_corrupt_messages_are_all_messages(self, spark):
        df = spark.createDataFrame([(i, m) for i, m in enumerate(self.MESSAGES)], "i INT, value STRING")
        parsed = parse_json_checked(df, "id INT, n INT", keep=("i",))
        rows = sorted(tuple(r) for r in parsed.rows.collect())
        assert rows[:2] == [(0, 1, 5), (1, 2, None)]
        corrupt = {r["i"]: r["_corrupt"] for r in parsed.corrupt.collect()}
        assert {2, 3, 4, 5} <= set(corrupt) and corrupt[3] == '{"id": 4'
        assert sorted([i for i, *_ in rows] + list(corrupt)) == list(range(len(self.MESSAGES)))

    def test_failfast_stops_at_a_broken_message(self, spark):
        df = spark.createDataFrame([(m,) for m in self.MESSAGES[:2]], "value STRING")
        assert parse_json_checked(df, "id INT, n INT", mode="failfast").count() == 2
        broken = spark.createDataFrame([('{"id": ',)], "value STRING")
        with pytest.raises(Exception, match="bad message"):
            parse_json_checked(broken, "id INT, n INT", mode="failfast").collect()

    def test_a_time_that_cannot_be_read_makes_a_corrupt_line(self, spark):
        lines = ["2024-01-01 08:00:00,10,EUR", "2024/01/01 08:00:00,10,EUR", "2024-01-01 08:00:00,x,EUR", "2024-01-01 08:00:00,10"]
        df = spark.createDataFrame([(line,) for line in lines], "value STRING")
        zones = {"o_time": "+08:00"}
        parsed = parse_lines(df, schemas.ORDER_LINE, zones=zones)
        assert [str(r["o_time"]) for r in parsed.rows.collect()] == ["2024-01-01 00:00:00"]
        assert sorted(r["_corrupt"] for r in parsed.corrupt.collect()) == sorted(lines[1:])
        with pytest.raises(Exception, match="bad line"):
            parse_lines(df, schemas.ORDER_LINE, mode="failfast", zones=zones).collect()


def test_an_upsert_to_null_clears_the_cell(spark):
    schema = "rowkey STRING, info STRUCT<name: STRING, age: STRING>"
    old = spark.createDataFrame([("1", ("ann", "20")), ("2", ("bob", "30"))], schema)
    new = spark.createDataFrame([("1", ("anna", None))], schema).withColumn("is_add", F.lit(True))
    cells = apply_to_cells(to_cells(old, F.lit(1)), new, F.lit(2))
    rows = sorted((r["rowkey"], r["info"]["name"], r["info"]["age"]) for r in read_rows(cells, schema).collect())
    assert rows == [("1", "anna", None), ("2", "bob", "30")]


def test_ties_in_a_lookup_keep_columns_of_one_row(spark):
    totals = "task_count course_count sum_task_type sum_creteria_type sum_time sum_create sum_other".split()
    at = "timestamp'2024-01-01 00:00:00'"
    performance = spark.range(1).selectExpr("'u' AS user_id", *[f"1 AS {t}" for t in totals], f"{at} AS max_proctime")
    users = spark.createDataFrame([("u", 1, 9), ("u", 2, 3)], "ref STRING, id INT, jid INT")
    row = performance_by_ref(performance, users, "ref", {"user_id": "id", "jid": "jid"}).first()
    assert (row["user_id"], row["jid"]) in [(1, 9), (2, 3)]


def test_a_catalog_table_is_not_dropped(spark, folder):
    for name in "ab":
        spark.range(3).write.parquet(f"{folder}/{name}")
    table = f"probe_{abs(hash(folder))}"
    register_parquet(spark, table, f"{folder}/a")
    register_parquet(spark, table, f"{folder}/a")
    with pytest.raises(ValueError):
        register_parquet(spark, table, f"{folder}/b")
    assert read_table(spark, table).count() == 3


def test_only_cells_of_asked_keys_are_put_together(spark):
    rows = spark.createDataFrame([("1",), ("3",), (None,)], "k STRING")
    schema = "rowkey STRING, info STRUCT<name: STRING>"
    cells = to_cells(spark.createDataFrame([("1", ("a",)), ("2", ("b",))], schema), F.lit(1))
    joined = lookup_in_cells(rows, cells, schema, "k", {"name": "info.name"}, how="left")
    assert sorted(map(tuple, joined.collect()), key=str) == sorted([("1", "a"), ("3", None), (None, None)], key=str)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Aggregate")


def test_routes_come_out_of_one_read(spark, sf_dir):
    from tidemark.plans import batch

    plan = batch.route_counts(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_pairs_for_a_function_move_each_side_once(spark, sf_dir):
    from tidemark.plans import batch

    plan = batch.cogroup_apply(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "REPARTITION" not in plan
