"""The driver's tables in the wire formats that the operators take in.

Each builder derives its messages from whole tables, so the queries go through the
real parsing path and their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import with_processing_time
from tidemark.session import use_utc
from tidemark.sources.topics import as_message

# Event type and the letter of the change it stands for.
OPERATIONS = {"signup": "c", "click": "u", "view": "r", "error": "d"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant and ``k`` out of the properties."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )


def naive(df: DataFrame, *names: str) -> DataFrame:
    """Instants as zone-free timestamps, the way the tables hold them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def _operation() -> Column:
    op = F.lit(None).cast("string")
    for event_type, letter in OPERATIONS.items():
        op = F.when(F.col("event_type") == event_type, letter).otherwise(op)
    return op


def change_messages(
    spark: SparkSession, sf_dir: str, nulls: bool = False, broken: bool = False
) -> DataFrame:
    """Change-event JSON in ``value`` with its arrival in ``proctime``.

    Creates and reads have no ``before``, deletes no ``after``. Every seventh event
    lacks ``after.TASK_ID``: the key is missing, or JSON null with ``nulls``. The
    ids of ``before`` differ, so taking the wrong image shows. With ``broken``, every
    13th message loses its end and every 17th has text for its time.
    """
    df = events(spark, sf_dir).withColumn("op", _operation())
    task = F.when(F.col("event_id") % 7 != 0, F.col("k"))

    def image(task_id: Column, course_id: Column) -> Column:
        return F.struct(
            F.col("user_id").cast("string").alias("USER_ID"),
            task_id.alias("TASK_ID"),
            course_id.alias("COURSE_ID"),
            (F.col("event_id") % 5).cast("int").alias("TASK_TYPE"),
            (F.col("event_id") % 3).cast("int").alias("CRETERIA_TYPE"),
            (F.col("k") * 1000).alias("C_TIME"),
        )

    has_before = F.col("op").isNull() | F.col("op").isin("u", "d")
    has_after = F.col("op").isNull() | (F.col("op") != "d")
    message = F.struct(
        F.when(has_before, image(F.col("k") + 100, F.col("k") % 10 + 20)).alias("before"),
        F.when(has_after, image(task, F.col("k") % 10)).alias("after"),
        "op",
        F.unix_millis("ts").alias("ts_ms"),
    )
    options = {"ignoreNullFields": "false" if nulls else "true"}
    value = F.to_json(message, options)
    if broken:
        cut = F.substring(value, 1, 20)
        wrong = F.regexp_replace(value, '"ts_ms":[0-9]+', '"ts_ms":"soon"')
        value = F.when(F.col("event_id") % 17 == 0, wrong).otherwise(value)
        value = F.when(F.col("event_id") % 13 == 0, cut).otherwise(value)
    messages = df.select("event_id", value.alias("value"), "ts")
    return with_processing_time(messages, at=F.col("ts")).drop("ts")


def key_value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id,k`` lines with the event's time and id."""
    return events(spark, sf_dir).select(
        F.concat_ws(",", "user_id", "k").alias("value"), "ts", "event_id"
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as ``time,amount,currency`` lines at UTC+8, the user as currency."""
    df = events(spark, sf_dir).filter("event_type = 'click'")
    line = F.concat_ws(",", _wall_clock(), (F.col("event_id") % 100).cast("string"), "user_id")
    return df.select(line.alias("value"), "ts", "event_id")


def time_lines(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """All events as ``time,amount,currency`` lines at UTC+8. With ``broken``, every
    13th has a time of another form and every 17th no currency."""
    df = events(spark, sf_dir)
    time, user = _wall_clock(), F.col("user_id").cast("string")
    if broken:
        time = F.when(F.col("event_id") % 13 == 0, F.translate(time, "-", "/")).otherwise(time)
        user = F.when(F.col("event_id") % 17 != 0, user)
    line = F.concat_ws(",", time, (F.col("event_id") % 100).cast("string"), user)
    return df.select(line.alias("value"), "ts", "event_id")


def rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as ``time,currency,rate`` lines at UTC+8."""
    df = events(spark, sf_dir).filter("event_type = 'view'")
    line = F.concat_ws(",", _wall_clock(), "user_id", (F.col("k") + 1).cast("string"))
    return df.select(line.alias("value"), "ts", "event_id")


def _wall_clock() -> Column:
    local = F.from_utc_timestamp("ts", "+08:00")
    return F.date_format(local, "yyyy-MM-dd HH:mm:ss")


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users, two versions each: a draft name first, then the real one."""
    df = table(spark, sf_dir, "customer").withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(1))))
    first = F.col("v") == 0
    name = F.when(first, F.lit("draft")).otherwise(F.col("c_name"))
    # Every fourth user has the age in the first version only.
    once = F.col("c_custkey") % 4 == 0
    age = F.when(
        first, F.when(once, F.col("c_nationkey")).otherwise(F.col("c_nationkey") + 50)
    ).otherwise(F.when(~once, F.col("c_nationkey")))
    return df.select(
        *as_message(
            "test_user",
            F.col("c_custkey").alias("uid"),
            name.alias("name"),
            age.cast("string").alias("age"),
        ),
        F.col("v").cast("string").alias("position"),
    )


def class_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as classes, the id as quoted text."""
    df = table(spark, sf_dir, "supplier")
    return df.select(
        *as_message(
            "test_class",
            F.col("s_suppkey").cast("string").alias("cid"),
            F.col("s_name").alias("cname"),
        ),
        F.lit("0").alias("position"),
    )


def link_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders as links of a user to a class."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_linenumber", "l_partkey"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    df = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    position = F.concat_ws(
        "|",
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        F.lpad(F.col("l_orderkey").cast("string"), 20, "0"),
        F.lpad(F.col("l_linenumber").cast("string"), 10, "0"),
        F.lpad(F.col("l_partkey").cast("string"), 20, "0"),
    )
    return df.select(
        *as_message(
            "test_class_user",
            F.col("l_suppkey").alias("cid"),
            F.col("o_custkey").alias("uid"),
            F.col("l_returnflag").alias("utype"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("c_time"),
        ),
        position.alias("position"),
    )


def membership_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three topics in one input."""
    return (
        user_messages(spark, sf_dir)
        .unionByName(class_messages(spark, sf_dir))
        .unionByName(link_messages(spark, sf_dir))
    )


def activity_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as enveloped messages, the event type as topic; errors lack the value."""
    body = F.to_json(
        F.struct(
            "event_id",
            F.col("user_id").cast("string").alias("user_id"),
            F.col("k").alias("k"),
        )
    )
    value = F.when(F.col("event_type") != "error", body)
    envelope = F.to_json(F.struct(F.col("event_type").alias("topic"), value.alias("value")))
    return events(spark, sf_dir).select(envelope.alias("value"))


def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the lookup table ``(ref, name, comment)``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ref"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("comment"),
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as wide-column rows: a suffixed row key and two families."""
    from tidemark.functions.shape import nested_row, suffixed_key

    return table(spark, sf_dir, "customer").select(
        suffixed_key(F.col("c_custkey"), "_key").alias("rowkey"),
        nested_row(
            uid=suffixed_key(F.col("c_custkey")),
            name=F.col("c_name"),
            age=suffixed_key(F.col("c_nationkey")),
        ).alias("info"),
        nested_row(segment=F.col("c_mktsegment")).alias("market"),
    )
