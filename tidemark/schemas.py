"""Declared schemas of the messages and tables, as Spark DDL. Nothing is inferred."""

# The field names and types of the messages and target tables.
CHANGE_ROW = (
    "USER_ID STRING, TASK_ID BIGINT, COURSE_ID BIGINT, "
    "TASK_TYPE INT, CRETERIA_TYPE INT, C_TIME BIGINT"
)
CHANGE_EVENT = (
    f"before STRUCT<{CHANGE_ROW}>, after STRUCT<{CHANGE_ROW}>, op STRING, ts_ms BIGINT"
)
CHANGE_EVENT_RAW_AFTER = (
    f"before STRUCT<{CHANGE_ROW}>, after STRING, op STRING, ts_ms BIGINT"
)
TASK_PERFORMANCE = (
    "user_id STRING, task_count BIGINT, course_count BIGINT, sum_task_type INT, "
    "sum_creteria_type INT, sum_time BIGINT, sum_create INT, sum_other INT, "
    "max_proctime TIMESTAMP"
)
PERFORMANCE_BY_REF = (
    "user_ref STRING, user_id BIGINT, jid BIGINT, task_count BIGINT, "
    "course_count BIGINT, sum_task_type INT, sum_creteria_type INT, "
    "sum_time BIGINT, sum_create INT, sum_other INT, m_time TIMESTAMP"
)
USER = "uid BIGINT, name STRING, age INT"
CLAZZ = "cid BIGINT, cname STRING"
CLAZZ_USER = "cid BIGINT, uid BIGINT, utype STRING"
USER_PROFILE = (
    "user_id INT, user_name STRING, user_type STRING, user_comment STRING, "
    "c_time TIMESTAMP, m_time TIMESTAMP"
)
KEY_VALUE_LINE = "key STRING, value INT"
USER_LINE = "uid STRING, age INT, sex INT"
ORDER_LINE = "o_time TIMESTAMP, o_amount INT, o_currency STRING"
RATE_LINE = "r_time TIMESTAMP, r_currency STRING, r_rate INT"
WIDE_WRITE = "rowkey STRING, info STRUCT<uid: STRING, name: STRING, age: STRING>"
CELLS = (
    "rowkey STRING, family STRING, qualifier STRING, value STRING, version BIGINT"
)


def parse_ddl(ddl: str):
    """DDL text to a ``StructType`` (needs an active Spark session)."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)
