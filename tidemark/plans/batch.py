"""Batch queries, one per operator, over the driver's tables."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.cdc import flatten_changes, flatten_changes_by_presence
from tidemark.functions.shape import (
    align_to,
    name_by_position,
    nested_row,
    product,
    project_nested,
    rename,
    suffixed_key,
)
from tidemark.functions.times import epoch_ms_text
from tidemark.operators.accumulate import average
from tidemark.operators.asof import asof_join, asof_join_bucketed
from tidemark.operators.changelog import apply_changelog, changelog_diff, inserts_only
from tidemark.operators.keyed import keyed_totals, parse_keyed, running_state
from tidemark.operators.latest import latest_by_key, latest_rows
from tidemark.operators.lookup import (
    latest_enriched,
    lookup_in_cells,
    lookup_in_ranges,
    lookup_join,
    performance_by_ref,
)
from tidemark.operators.membership import (
    joined_membership,
    latest_membership,
    latest_membership_windowed,
)
from tidemark.operators.performance import task_performance, task_performance_recent
from tidemark.operators.routing import parse_branch, route_labelled
from tidemark.operators.sketches import daily_sketches, distinct_in_span
from tidemark.operators.windowjoin import co_group_apply, window_join
from tidemark.operators.windows import (
    tumbling_average,
    tumbling_average_with_start,
    tumbling_sum,
    tumbling_sum_with_start,
)
from tidemark.plans import inputs
from tidemark.session import new_folder
from tidemark.sinks.cells import cell_sink, read_cells
from tidemark.sinks.search import documents
from tidemark.sinks.upsert import keyed_table
from tidemark.sinks.widecolumn import WriteOptions, apply_to_cells, to_cells
from tidemark.sources.catalog import read_table, register_parquet, save_bucketed
from tidemark.sources.lines import ParsedLines, parse_lines, read_lines
from tidemark.sources.ranges import read_ranges, write_ranges
from tidemark.sources.topics import (
    parse_json,
    parse_json_checked,
    unwrap_envelope,
    unwrap_topic_envelope,
)
from tidemark.sources.widecolumn import read_rows

LINE_ZONE = "+08:00"
DAY = "1 day"
DAY_SECONDS = 86_400
WEEK = "7 days"
# The half of the events' month, where the changelog queries take their snapshot.
CUT = "2024-01-16 00:00:00"


def flat_changes(spark: SparkSession, sf: str) -> DataFrame:
    messages = inputs.change_messages(spark, sf)
    parsed = parse_json(messages, schemas.CHANGE_EVENT, keep=("event_id", "proctime"))
    return flatten_changes(parsed, keep=("event_id", "proctime"))


def cdc_flat(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.naive(flat_changes(spark, sf), "ts_ms", "proctime")


def performance(spark: SparkSession, sf: str) -> DataFrame:
    result = align_to(task_performance(flat_changes(spark, sf)), schemas.TASK_PERFORMANCE)
    return inputs.naive(result, "max_proctime")


def performance_recent(spark: SparkSession, sf: str) -> DataFrame:
    flat = flat_changes(spark, sf)
    newest = inputs.events(spark, sf).agg(F.max("ts")).scalar()
    recent = task_performance_recent(flat, newest, minutes=24 * 60)
    recent = align_to(recent, schemas.TASK_PERFORMANCE)
    return inputs.naive(recent, "max_proctime")


def cdc_presence(spark: SparkSession, sf: str) -> DataFrame:
    messages = inputs.change_messages(spark, sf, nulls=True)
    inner = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    wrapped = messages.select("event_id", F.to_json(F.struct(inner.alias("value"))).alias("value"))
    return flatten_changes_by_presence(
        unwrap_envelope(wrapped, keep=("event_id",)), keep=("event_id",)
    )


def json_schema_projection(spark: SparkSession, sf: str) -> DataFrame:
    messages = inputs.change_messages(spark, sf)
    parsed = parse_json(messages, schemas.CHANGE_EVENT_RAW_AFTER, keep=("event_id",))
    return project_nested(
        parsed, event_id="event_id", after="after", old_user="before.USER_ID", op="op"
    )


def activity_edges() -> dict[str, Column | None]:
    return {
        "clicks": F.col("topic") == "click",
        "views": F.col("topic") == "view",
        "no_signups": F.col("topic") != "signup",
        "all": None,
    }


def branch_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("branch").agg(
        F.count("*").alias("n"), F.sum("k").alias("sum_k"), F.max("user_id").alias("max_user")
    )


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    messages = unwrap_topic_envelope(inputs.activity_topics(spark, sf))
    rows = parse_branch(messages, "event_id BIGINT, user_id BIGINT, k INT", keep=("topic",))
    return branch_totals(route_labelled(rows, activity_edges()))


def measured_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose ``k`` is missing now and then, to see that NULLs are skipped."""
    df = inputs.events(spark, sf)
    return df.withColumn("k", F.when(F.col("k") % 7 != 0, F.col("k")))


def latest_by_user(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_by_key(
        measured_events(spark, sf),
        ["user_id"],
        ["event_type", "k"],
        ["ts", "event_id"],
        times={"ts": "t"},
    ).withColumnsRenamed({"t_min": "c_time", "t_max": "m_time"})
    return inputs.naive(latest, "c_time", "m_time")


def latest_row_by_user(spark: SparkSession, sf: str) -> DataFrame:
    rows = measured_events(spark, sf).select("user_id", "event_id", "event_type", "k", "ts")
    return inputs.naive(latest_rows(rows, ["user_id"], ["ts", "event_id"]), "ts")


def accumulator_merge(spark: SparkSession, sf: str) -> DataFrame:
    accumulator = average("k")
    by_type = accumulator.partial(inputs.events(spark, sf), ["user_id", "event_type"])
    merged = accumulator.merged(by_type, ["user_id"])
    return accumulator.finished(merged, ["user_id"])


def _branches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    def parsed(messages: DataFrame, schema: str) -> DataFrame:
        return parse_json(messages, schema, keep=("position",), lenient=True)

    return (
        parsed(inputs.user_messages(spark, sf), schemas.USER),
        parsed(inputs.class_messages(spark, sf), schemas.CLAZZ),
        parsed(inputs.link_messages(spark, sf), f"{schemas.CLAZZ_USER}, c_time TIMESTAMP"),
    )


def membership_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_membership(*_branches(spark, sf), order=["position"])


def membership_latest_windowed(spark: SparkSession, sf: str) -> DataFrame:
    return latest_membership_windowed(*_branches(spark, sf), order=["position"], size=WEEK)


def membership_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The latest values as saved tables, users and links in the same buckets."""
    users, classes, links = _branches(spark, sf)
    latest = {
        "users": (latest_by_key(users, ["uid"], ["name", "age"], ["position"]), ["uid"]),
        "classes": (latest_by_key(classes, ["cid"], ["cname"], ["position"]), ["cid"]),
        "links": (latest_by_key(links, ["uid", "cid"], ["utype"], ["position"]), ["uid"]),
    }
    saved = {}
    for name, (rows, by) in latest.items():
        table = f"tidemark_{name}_{zlib.crc32(sf.encode())}"
        saved[name] = save_bucketed(rows, table, by, 8, new_folder(spark, f"saved-{name}"))
    return joined_membership(saved["users"], saved["classes"], saved["links"])


def parsed_orders(lines: DataFrame) -> ParsedLines:
    zones = {"o_time": LINE_ZONE}
    return parse_lines(lines, schemas.ORDER_LINE, keep=("event_id",), zones=zones)


def parsed_rates(lines: DataFrame) -> ParsedLines:
    zones = {"r_time": LINE_ZONE}
    return parse_lines(lines, schemas.RATE_LINE, keep=("event_id",), zones=zones)


def as_orders(rows: DataFrame) -> DataFrame:
    names = {"o_time": "o_rowtime", "o_currency": "currency"}
    return rename(rows, names).select("event_id", "o_rowtime", "o_amount", "currency")


def as_rates(rows: DataFrame) -> DataFrame:
    names = {"event_id": "rate_id", "r_time": "r_rowtime", "r_currency": "currency"}
    return rename(rows, names).select("rate_id", "r_rowtime", "r_rate", "currency")


def orders_and_rates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = parsed_orders(inputs.order_lines(spark, sf)).rows
    rates = parsed_rates(inputs.rate_lines(spark, sf)).rows
    return as_orders(orders), as_rates(rates)


def amounts(joined: DataFrame) -> DataFrame:
    return joined.select(
        "event_id",
        F.col("currency").alias("r_currency"),
        product(F.col("o_amount"), F.col("r_rate")).alias("amount"),
    )


def asof_amount(spark: SparkSession, sf: str) -> DataFrame:
    orders, rates = orders_and_rates(spark, sf)
    return amounts(
        asof_join(orders, rates, ["currency"], "o_rowtime", "r_rowtime", ["rate_id"])
    )


def asof_amount_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    orders, rates = orders_and_rates(spark, sf)
    return amounts(
        asof_join_bucketed(
            orders, rates, ["currency"], "o_rowtime", "r_rowtime", DAY_SECONDS, ["rate_id"]
        )
    )


def local_time_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = parsed_orders(inputs.time_lines(spark, sf)).rows
    return rows.select("event_id", epoch_ms_text(F.col("o_time")).alias("epoch_ms"))


def corrupt_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose time, amount or end is not what the schema declares."""
    return parsed_orders(inputs.time_lines(spark, sf, broken=True)).corrupt


def corrupt_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that are no JSON, or hold another type than declared."""
    messages = inputs.change_messages(spark, sf, broken=True)
    corrupt = parse_json_checked(messages, schemas.CHANGE_EVENT, keep=("event_id",)).corrupt
    return corrupt.select("event_id", (F.length("_corrupt") == 20).alias("cut"))


def whole_messages(spark: SparkSession, sf: str) -> DataFrame:
    """What parses of the same messages: with the corrupt ones, all of them."""
    messages = inputs.change_messages(spark, sf, broken=True)
    rows = parse_json_checked(messages, schemas.CHANGE_EVENT, keep=("event_id",)).rows
    return rows.select("event_id", "op", "ts_ms")


def _keyed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return parse_keyed(inputs.key_value_lines(spark, sf), keep=("ts", "event_id"))


def keyed_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed_lines(spark, sf).select("event_id", "key", "value")


def tumbling_sum_start(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling_sum_with_start(_keyed_lines(spark, sf), "key", "value", "ts", DAY)


def tumbling_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling_sum(_keyed_lines(spark, sf), "key", "value", "ts", DAY)


def tumbling_avg(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling_average(_keyed_lines(spark, sf), "key", "value", "ts", DAY)


def tumbling_avg_start(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling_average_with_start(_keyed_lines(spark, sf), "key", "value", "ts", DAY)


def clicks_and_views(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    df = inputs.events(spark, sf)
    clicks = df.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click"))
    views = df.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view"))
    return clicks, views


def tagged(joined: DataFrame, tag: str) -> DataFrame:
    return joined.select(
        F.lit(tag).alias("tag"),
        "user_id",
        epoch_ms_text(F.col("window_end")).alias("window_end"),
        "click",
        "view",
    )


def window_inner(spark: SparkSession, sf: str) -> DataFrame:
    clicks, views = clicks_and_views(spark, sf)
    return tagged(window_join(clicks, views, ["user_id"], "ts", DAY), "JOIN")


def window_left(spark: SparkSession, sf: str) -> DataFrame:
    clicks, views = clicks_and_views(spark, sf)
    return tagged(window_join(clicks, views, ["user_id"], "ts", DAY, "left"), "CoGroup")


def _pairs_or_alone(pairs: pa.RecordBatch) -> pa.RecordBatch:
    return pairs.select(["user_id", "day", "click", "view"])


def cogroup_apply(spark: SparkSession, sf: str) -> DataFrame:
    clicks, views = clicks_and_views(spark, sf)
    day = F.unix_date(F.col("ts").cast("date"))
    return co_group_apply(
        clicks.select("user_id", day.alias("day"), "click"),
        views.select("user_id", day.alias("day"), "view"),
        ["user_id", "day"],
        _pairs_or_alone,
        "user_id BIGINT, day INT, click BIGINT, view BIGINT",
    )


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    """Events that point at customers; at larger ids there is no such customer."""
    return inputs.events(spark, sf).select(
        "event_id", (F.col("user_id") * 20).cast("int").alias("rrr"), "event_type", "k", "ts"
    )


def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    joined = lookup_join(
        _visits(spark, sf),
        inputs.customer_lookup(spark, sf),
        "rrr",
        "ref",
        "left",
        {"name": "name", "comment": "comment"},
    )
    return joined.select("event_id", "rrr", "name", "comment")


def lookup_inner(spark: SparkSession, sf: str) -> DataFrame:
    visits = _visits(spark, sf).withColumn("user_key", suffixed_key(F.col("rrr"), "_key"))
    cells = to_cells(inputs.customer_rows(spark, sf), F.lit(1))
    schema = f"{schemas.WIDE_WRITE}, market STRUCT<segment: STRING>"
    joined = lookup_in_cells(
        visits, cells, schema, "user_key", {"jid": "info.uid", "name": "info.name"}, ["info"]
    )
    return joined.select("event_id", "jid", "name")


def lookup_ranged(spark: SparkSession, sf: str) -> DataFrame:
    """The visits of the last day against a table in ranges of the row key."""
    folder = new_folder(spark, "ranged-cells")
    write_ranges(to_cells(inputs.customer_rows(spark, sf), F.lit(1)), folder, 16)
    visits = _visits(spark, sf).withColumn("user_key", suffixed_key(F.col("rrr"), "_key"))
    recent = visits.filter(F.col("ts") >= "2024-01-30")
    joined = lookup_in_ranges(
        recent,
        read_ranges(spark, folder),
        f"{schemas.WIDE_WRITE}, market STRUCT<segment: STRING>",
        "user_key",
        {"jid": "info.uid", "name": "info.name"},
        ["info"],
    )
    return joined.select("event_id", "jid", "name")


def visitors(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("k") % 7 != 0, F.col("event_type"))
    return _visits(spark, sf).select("event_id", "rrr", kind.alias("type"), "ts")


def as_profile(latest: DataFrame) -> DataFrame:
    named = rename(
        latest, {"rrr": "user_id", "type": "user_type", "name": "user_name", "comment": "user_comment"}
    )
    return inputs.naive(align_to(named, schemas.USER_PROFILE), "c_time", "m_time")


def lookup_enrich(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_enriched(
        visitors(spark, sf),
        inputs.customer_lookup(spark, sf),
        "rrr",
        "ref",
        {"name": "name", "comment": "comment"},
        own=["type"],
        order=["ts", "event_id"],
        time="ts",
    )
    return as_profile(latest)


def enrich_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    users = inputs.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ref"),
        F.col("c_nationkey").cast("bigint").alias("id"),
        (F.col("c_custkey") * 2).alias("jid"),
    )
    joined = performance_by_ref(
        task_performance(flat_changes(spark, sf)), users, "ref", {"user_id": "id", "jid": "jid"}
    )
    return inputs.naive(align_to(joined, schemas.PERFORMANCE_BY_REF), "m_time")


def _customer_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells in two versions; the older ones hold other values."""
    rows = inputs.customer_rows(spark, sf)
    newest = to_cells(rows, F.lit(2))
    older = newest.withColumn("value", F.concat(F.lit("old "), "value")).withColumn(
        "version", F.lit(1).cast("bigint")
    )
    return newest.unionByName(older)


def wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_rows(_customer_cells(spark, sf), schemas.WIDE_WRITE)
    return project_nested(
        rows, rowkey="rowkey", uid="info.uid", name="info.name", age="info.age"
    )


def wide_cells(spark: SparkSession, sf: str) -> DataFrame:
    return to_cells(inputs.customer_rows(spark, sf), F.lit(1))


def wide_cells_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Cells through the buffering sink in two batches, the second one delivered twice."""
    folder = new_folder(spark, "cells-sink")
    cells = wide_cells(spark, sf)
    sink = cell_sink(folder, WriteOptions("customer", "store", flush_rows=1000))
    named = F.col("qualifier") == "name"
    for batch_id, part in ((0, ~named), (1, named), (1, named)):
        sink(cells.filter(part), batch_id)
    return read_cells(spark, folder)


def wide_cells_applied(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.customer_rows(spark, sf)
    left = F.col("market.segment") == "MACHINERY"
    gone = rows.filter(left).withColumn("is_add", F.lit(False))
    moved = rows.filter(left & (F.col("info.age").cast("int") < 5)).select(
        "rowkey",
        nested_row(uid=F.col("info.uid"), name=F.lit("moved"), age=F.col("info.age")).alias("info"),
        "market",
        F.lit(True).alias("is_add"),
    )
    cells = to_cells(rows, F.lit(1))
    return apply_to_cells(cells, gone.unionByName(moved), F.lit(2))


def _state_until(spark: SparkSession, sf: str, cut: str | None) -> DataFrame:
    """Latest event type per user; a user may have the same one at both times."""
    df = inputs.events(spark, sf)
    if cut is not None:
        df = df.filter(F.col("ts") < F.lit(cut).cast("timestamp"))
    return latest_by_key(df, ["user_id"], ["event_type"], ["ts", "event_id"])


def changelog(spark: SparkSession, sf: str) -> DataFrame:
    return changelog_diff(
        _state_until(spark, sf, CUT), _state_until(spark, sf, None), ["user_id"]
    )


def changelog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    before = _state_until(spark, sf, CUT)
    after = _state_until(spark, sf, None)
    return apply_changelog(before, changelog_diff(before, after, ["user_id"]))


def append_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return inserts_only(_keyed_lines(spark, sf).select("event_id", "key", "value"))


def _customer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``uid,age,sex`` lines; every tenth has a bad number, every eleventh no end."""
    number = F.col("c_custkey")
    age = F.when(number % 10 == 0, F.lit("x")).otherwise(F.col("c_nationkey").cast("string"))
    sex = F.when(number % 11 != 0, (number % 2).cast("string"))
    return inputs.table(spark, sf, "customer").select(
        F.concat_ws(",", number.cast("string"), age, sex).alias("value")
    )


def csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(_customer_lines(spark, sf), schemas.USER_LINE).rows


def corrupt_rows(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(_customer_lines(spark, sf), schemas.USER_LINE).corrupt


def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "text-lines")
    _customer_lines(spark, sf).write.text(folder)
    return read_lines(spark, folder)


def catalog_select(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/customer.parquet"
    name = f"tidemark_customer_{zlib.crc32(path.encode())}"
    register_parquet(spark, name, path)
    named = rename(
        read_table(spark, name),
        {"c_custkey": "uid", "c_name": "name", "c_nationkey": "age"},
    )
    chosen = named.filter(F.col("c_mktsegment") == "MACHINERY")
    return align_to(name_by_position(chosen.select("uid", "name", "age"), "uid", "name", "age"), schemas.USER)


def distinct_by_span(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values of a span of days, out of sketches of each day."""
    rows = measured_events(spark, sf)
    sketches = daily_sketches(rows, ["user_id"], "ts", ["k", "event_type"])
    counts = {"k": "values", "event_type": "types"}
    return distinct_in_span(sketches, ["user_id"], counts, "2024-01-05", "2024-01-24")


def running(spark: SparkSession, sf: str) -> DataFrame:
    lines = _keyed_lines(spark, sf).select("key", "value", "ts", "event_id")
    return running_state(lines, "key", "value", ["ts", "event_id"]).drop("ts")


def totals(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_totals(_keyed_lines(spark, sf), "key", "value")


def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    sent = documents(performance(spark, sf).drop("max_proctime"), ["user_id"])
    schema = schemas.TASK_PERFORMANCE.replace(", max_proctime TIMESTAMP", "")
    return parse_json(sent, schema, value="json", keep=("doc_id",))


def upsert_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Three stretches of the events as batches, the second one delivered twice."""
    rows = inputs.events(spark, sf).select("user_id", "event_id", "event_type", "k", "ts")
    target = keyed_table(
        spark,
        new_folder(spark, "upsert-snapshot"),
        "user_id BIGINT, event_id BIGINT, event_type STRING, k BIGINT, ts TIMESTAMP",
        ["user_id"],
        ["ts", "event_id"],
    )
    day = F.col("ts").cast("date")
    # Rows without a time come with the last batch.
    first = F.coalesce(day < "2024-01-11", F.lit(False))
    second = F.coalesce(day < "2024-01-21", F.lit(False))
    for batch_id, part in [(0, first), (1, ~first & second), (1, ~first & second), (2, ~second)]:
        target.put(rows.filter(part), batch_id)
    return inputs.naive(target.read(), "ts")


BATCH_QUERIES = {
    "task_performance": performance,
    "task_performance_recent": performance_recent,
    "cdc_flat": cdc_flat,
    "cdc_presence": cdc_presence,
    "json_schema_projection": json_schema_projection,
    "route_counts": route_counts,
    "latest_by_user": latest_by_user,
    "latest_row_by_user": latest_row_by_user,
    "accumulator_merge": accumulator_merge,
    "membership_latest": membership_latest,
    "membership_latest_windowed": membership_latest_windowed,
    "membership_bucketed": membership_bucketed,
    "asof_amount": asof_amount,
    "asof_amount_bucketed": asof_amount_bucketed,
    "local_time_parse": local_time_parse,
    "keyed_passthrough": keyed_passthrough,
    "tumbling_sum": tumbling_sum_start,
    "tumbling_reduce": tumbling_reduce,
    "tumbling_avg": tumbling_avg,
    "tumbling_avg_start": tumbling_avg_start,
    "window_join": window_inner,
    "window_left": window_left,
    "cogroup_apply": cogroup_apply,
    "lookup_left": lookup_left,
    "lookup_inner": lookup_inner,
    "lookup_ranged": lookup_ranged,
    "lookup_enrich": lookup_enrich,
    "enrich_aggregate": enrich_aggregate,
    "wide_rows": wide_rows,
    "wide_cells": wide_cells,
    "wide_cells_applied": wide_cells_applied,
    "wide_cells_sink": wide_cells_sink,
    "changelog": changelog,
    "changelog_roundtrip": changelog_roundtrip,
    "append_changelog": append_changelog,
    "csv_typed": csv_typed,
    "corrupt_orders": corrupt_orders,
    "corrupt_messages": corrupt_messages,
    "whole_messages": whole_messages,
    "corrupt_rows": corrupt_rows,
    "text_lines": text_lines,
    "catalog_select": catalog_select,
    "distinct_by_span": distinct_by_span,
    "running_state": running,
    "keyed_totals": totals,
    "search_documents": search_documents,
    "upsert_snapshot": upsert_snapshot,
}
