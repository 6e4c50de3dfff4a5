"""SQL twins of the registered queries, straight from the tables' columns."""

from __future__ import annotations

# Every statement is standard SQL plus the reader engine's JSON and as-of syntax.
_EVENTS = """
e AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events
)"""

_FLAT = f"""{_EVENTS},
flat AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_type = 'error' THEN k + 100
              WHEN event_id % 7 <> 0 THEN k
              WHEN event_type IN ('click', 'purchase') THEN k + 100
         END AS task_id,
         CASE WHEN event_type = 'error' THEN k % 10 + 20 ELSE k % 10 END AS course_id,
         CAST(event_id % 5 AS INTEGER) AS task_type,
         CAST(event_id % 3 AS INTEGER) AS creteria_type,
         k * 1000 AS c_time,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u'
                         WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' END AS op,
         date_trunc('second', ts) AS ts_ms,
         ts AS proctime
  FROM e
)"""

_PERFORMANCE_COLUMNS = """
  COUNT(DISTINCT task_id) AS task_count,
  COUNT(DISTINCT course_id) AS course_count,
  CAST(SUM(task_type) AS INTEGER) AS sum_task_type,
  CAST(SUM(creteria_type) AS INTEGER) AS sum_creteria_type,
  CAST(SUM(c_time) AS BIGINT) AS sum_time,
  CAST(SUM(CASE WHEN op = 'c' THEN 1 ELSE 0 END) AS INTEGER) AS sum_create,
  CAST(SUM(CASE WHEN op <> 'c' THEN 1 ELSE 0 END) AS INTEGER) AS sum_other,
  MAX(proctime) AS max_proctime"""

_PERFORMANCE = f"""
WITH {_FLAT}
SELECT user_id, {_PERFORMANCE_COLUMNS}
FROM flat GROUP BY user_id"""

_LINKS = """
links AS (
  SELECT o_custkey AS uid, l_suppkey AS cid, l_returnflag AS utype, l_shipdate,
         ROW(l_shipdate, l_orderkey, l_linenumber, l_partkey) AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_MEMBERSHIP = f"""
WITH {_LINKS},
latest AS (SELECT uid, cid, arg_max(utype, pos) AS utype FROM links GROUP BY uid, cid)
SELECT uid, cid, c_name AS name, c_nationkey AS age, s_name AS cname, utype
FROM latest JOIN customer ON uid = c_custkey JOIN supplier ON cid = s_suppkey"""

_ASOF = f"""
WITH {_EVENTS},
orders_in AS (
  SELECT event_id, user_id, date_trunc('second', ts) AS t, event_id % 100 AS amount
  FROM e WHERE event_type = 'click'
),
rates_in AS (
  SELECT user_id, date_trunc('second', ts) AS t, arg_max(k + 1, event_id) AS rate
  FROM e WHERE event_type = 'view' GROUP BY ALL
)
SELECT o.event_id, CAST(o.user_id AS VARCHAR) AS r_currency,
       CAST(o.amount * r.rate AS BIGINT) AS amount
FROM orders_in o ASOF JOIN rates_in r ON o.user_id = r.user_id AND o.t >= r.t"""

_DAY_MS = 86_400_000


def _tumbling(columns: str) -> str:
    return f"""
WITH {_EVENTS}
SELECT {columns} FROM (
  SELECT CAST(user_id AS VARCHAR) AS key, ms // {_DAY_MS} * {_DAY_MS} AS start,
         CAST(SUM(k) AS BIGINT) AS s, CAST(SUM(k) AS DOUBLE) / COUNT(k) AS a
  FROM e GROUP BY 1, 2
)"""


def _window_join(tag: str, how: str) -> str:
    return f"""
WITH {_EVENTS},
c AS (SELECT user_id, ms // {_DAY_MS} AS d, event_id FROM e WHERE event_type = 'click'),
v AS (SELECT user_id, ms // {_DAY_MS} AS d, event_id FROM e WHERE event_type = 'view')
SELECT '{tag}' AS tag, c.user_id, CAST((c.d + 1) * {_DAY_MS} AS VARCHAR) AS window_end,
       c.event_id AS click, v.event_id AS view
FROM c {how} JOIN v ON c.user_id = v.user_id AND c.d = v.d"""


_LOOKUP_LEFT = f"""
WITH {_EVENTS}
SELECT event_id, CAST(user_id * 20 AS INTEGER) AS rrr, c_name AS name, c_mktsegment AS comment
FROM e LEFT JOIN customer ON user_id * 20 = c_custkey"""

_LOOKUP_ENRICH = f"""
WITH {_EVENTS}
SELECT CAST(user_id * 20 AS INTEGER) AS user_id,
       arg_max(c_name, ROW(ts, event_id)) FILTER (WHERE c_name IS NOT NULL) AS user_name,
       arg_max(event_type, ROW(ts, event_id)) FILTER (WHERE k % 7 <> 0) AS user_type,
       arg_max(c_mktsegment, ROW(ts, event_id)) FILTER (WHERE c_mktsegment IS NOT NULL)
         AS user_comment,
       MIN(ts) AS c_time, MAX(ts) AS m_time
FROM e LEFT JOIN customer ON user_id * 20 = c_custkey
GROUP BY e.user_id"""

_LATEST_ROW = f"""
WITH {_EVENTS}
SELECT user_id, event_id, event_type, k, ts FROM e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

_STATES = f"""{_EVENTS},
old AS (
  SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS event_type
  FROM e WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id
),
new AS (
  SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS event_type
  FROM e GROUP BY user_id
)"""

_CHANGES = f"""
WITH {_STATES}
SELECT false AS is_add, old.user_id, old.event_type
FROM old LEFT JOIN new USING (user_id) WHERE old.event_type IS DISTINCT FROM new.event_type
UNION ALL
SELECT true, new.user_id, new.event_type
FROM new LEFT JOIN old USING (user_id) WHERE old.event_type IS DISTINCT FROM new.event_type"""

_CELLS = """
cells AS (
  SELECT c_custkey || '_key' AS rowkey, c_nationkey, c_mktsegment,
         unnest([
           {'family': 'info', 'qualifier': 'uid', 'value': CAST(c_custkey AS VARCHAR)},
           {'family': 'info', 'qualifier': 'name', 'value': c_name},
           {'family': 'info', 'qualifier': 'age', 'value': CAST(c_nationkey AS VARCHAR)},
           {'family': 'market', 'qualifier': 'segment', 'value': c_mktsegment}
         ]) AS c
  FROM customer
)"""

_CUSTOMER_LINES = """
lines AS (
  SELECT c_custkey, c_nationkey,
         c_custkey || ',' || CASE WHEN c_custkey % 10 = 0 THEN 'x'
                                  ELSE CAST(c_nationkey AS VARCHAR) END
                   || CASE WHEN c_custkey % 11 <> 0 THEN ',' || (c_custkey % 2)
                           ELSE '' END AS value
  FROM customer
)"""

_RUNNING = f"""
WITH {_EVENTS}
SELECT CAST(user_id AS VARCHAR) AS key, CAST(k AS INTEGER) AS value, event_id,
       COUNT(*) OVER w AS running_count, CAST(SUM(k) OVER w AS BIGINT) AS running_sum
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""

_TOTALS = f"""
WITH {_EVENTS}
SELECT CAST(user_id AS VARCHAR) AS key, COUNT(*) AS running_count,
       CAST(SUM(k) AS BIGINT) AS running_sum
FROM e GROUP BY user_id"""

ORACLE_SQL = {
    "task_performance": _PERFORMANCE,
    "task_performance_recent": f"""
WITH {_FLAT}
SELECT user_id, {_PERFORMANCE_COLUMNS}
FROM flat
WHERE proctime >= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY
GROUP BY user_id""",
    "cdc_flat": f"""
WITH {_FLAT}
SELECT user_id, task_id, course_id, task_type, creteria_type, c_time, op, ts_ms,
       event_id, proctime
FROM flat""",
    "cdc_presence": f"""
WITH {_FLAT}
SELECT flat.event_id, flat.user_id,
       CASE WHEN event_type = 'error' THEN k + 100 WHEN flat.event_id % 7 <> 0 THEN k END
         AS task_id,
       course_id, task_type, creteria_type, c_time, op, ms AS ts_ms
FROM flat JOIN e ON flat.event_id = e.event_id
WHERE flat.event_id % 9 <> 0""",
    "json_schema_projection": f"""
WITH {_FLAT}
SELECT flat.event_id,
       CASE WHEN event_type <> 'error' THEN
         '{{"USER_ID":"' || flat.user_id || '",'
         || CASE WHEN flat.event_id % 7 <> 0 THEN '"TASK_ID":' || k || ',' ELSE '' END
         || '"COURSE_ID":' || course_id || ',"TASK_TYPE":' || task_type
         || ',"CRETERIA_TYPE":' || creteria_type || ',"C_TIME":' || c_time || '}}'
       END AS after,
       CASE WHEN event_type IN ('click', 'error', 'purchase') THEN flat.user_id END
         AS old_user,
       op
FROM flat JOIN e ON flat.event_id = e.event_id""",
    "route_counts": f"""
WITH {_EVENTS},
sent AS (SELECT * FROM e WHERE event_type <> 'error'),
routed AS (
  SELECT 'clicks' AS branch, k, user_id FROM sent WHERE event_type = 'click'
  UNION ALL SELECT 'views', k, user_id FROM sent WHERE event_type = 'view'
  UNION ALL SELECT 'no_signups', k, user_id FROM sent WHERE event_type <> 'signup'
  UNION ALL SELECT 'all', k, user_id FROM sent
)
SELECT branch, COUNT(*) AS n, CAST(SUM(k) AS BIGINT) AS sum_k, MAX(user_id) AS max_user
FROM routed GROUP BY branch""",
    "latest_by_user": f"""
WITH {_EVENTS}
SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS event_type,
       arg_max(k, ROW(ts, event_id)) FILTER (WHERE k % 7 <> 0) AS k,
       MIN(ts) AS c_time, MAX(ts) AS m_time
FROM e GROUP BY user_id""",
    "latest_row_by_user": f"""
WITH r AS ({_LATEST_ROW})
SELECT user_id, event_id, event_type, CASE WHEN k % 7 <> 0 THEN k END AS k, ts FROM r""",
    "accumulator_merge": f"""
WITH {_EVENTS}
SELECT user_id, CAST(SUM(k) AS DOUBLE) / COUNT(k) AS average FROM e GROUP BY user_id""",
    "membership_latest": _MEMBERSHIP,
    "membership_bucketed": _MEMBERSHIP,
    "membership_latest_windowed": f"""
WITH {_LINKS},
latest AS (
  SELECT uid, cid, epoch_us(l_shipdate) // 1000 // (7 * {_DAY_MS}) * (7 * {_DAY_MS}) AS start,
         arg_max(utype, pos) AS utype
  FROM links GROUP BY 1, 2, 3
)
SELECT uid, cid, CAST(start AS VARCHAR) AS window_start, c_name AS name,
       c_nationkey AS age, s_name AS cname, utype
FROM latest JOIN customer ON uid = c_custkey JOIN supplier ON cid = s_suppkey""",
    "asof_amount": _ASOF,
    "asof_amount_bucketed": _ASOF,
    "local_time_parse": """
SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) // 1000 AS VARCHAR) AS epoch_ms
FROM events""",
    "corrupt_orders": """
SELECT event_id, concat_ws(',',
    replace(strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S'), '-',
      CASE WHEN event_id % 13 = 0 THEN '/' ELSE '-' END),
    CAST(event_id % 100 AS VARCHAR),
    CASE WHEN event_id % 17 <> 0 THEN CAST(user_id AS VARCHAR) END) AS _corrupt
FROM events WHERE event_id % 13 = 0 OR event_id % 17 = 0""",
    "corrupt_messages": """
SELECT event_id, event_id % 13 = 0 AS cut
FROM events WHERE event_id % 13 = 0 OR event_id % 17 = 0""",
    "whole_messages": f"""
WITH {_EVENTS}
SELECT event_id, ms AS ts_ms,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u'
                       WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' END AS op
FROM e WHERE event_id % 13 <> 0 AND event_id % 17 <> 0""",
    "keyed_passthrough": f"""
WITH {_EVENTS}
SELECT event_id, CAST(user_id AS VARCHAR) AS key, CAST(k AS INTEGER) AS value FROM e""",
    "tumbling_sum": _tumbling("key, s AS sum, CAST(start AS VARCHAR) AS window_start"),
    "tumbling_reduce": _tumbling("key, s AS sum"),
    "tumbling_avg": _tumbling("key, a AS average"),
    "tumbling_avg_start": _tumbling(
        "key, CAST(start AS VARCHAR) AS window_start, a AS average"
    ),
    "window_join": _window_join("JOIN", "INNER"),
    "window_left": _window_join("CoGroup", "LEFT"),
    "cogroup_apply": f"""
WITH p AS ({_window_join("CoGroup", "LEFT")})
SELECT user_id, CAST(CAST(window_end AS BIGINT) // {_DAY_MS} - 1 AS INTEGER) AS day,
       click, view
FROM p""",
    "lookup_left": _LOOKUP_LEFT,
    "lookup_inner": f"""
WITH {_EVENTS}
SELECT event_id, CAST(c_custkey AS VARCHAR) AS jid, c_name AS name
FROM e JOIN customer ON user_id * 20 = c_custkey""",
    "lookup_ranged": f"""
WITH {_EVENTS}
SELECT event_id, CAST(c_custkey AS VARCHAR) AS jid, c_name AS name
FROM e JOIN customer ON user_id * 20 = c_custkey WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'""",
    "lookup_enrich": _LOOKUP_ENRICH,
    "enrich_aggregate": f"""
WITH p AS ({_PERFORMANCE})
SELECT p.user_id AS user_ref, CAST(c_nationkey AS BIGINT) AS user_id,
       CAST(c_custkey * 2 AS BIGINT) AS jid, task_count, course_count,
       CAST(sum_task_type AS INTEGER) AS sum_task_type,
       CAST(sum_creteria_type AS INTEGER) AS sum_creteria_type, sum_time,
       CAST(sum_create AS INTEGER) AS sum_create, CAST(sum_other AS INTEGER) AS sum_other,
       max_proctime AS m_time
FROM p JOIN customer ON p.user_id = CAST(c_custkey AS VARCHAR)""",
    "wide_rows": """
SELECT c_custkey || '_key' AS rowkey, CAST(c_custkey AS VARCHAR) AS uid, c_name AS name,
       CAST(c_nationkey AS VARCHAR) AS age
FROM customer""",
    "wide_cells": f"""
WITH {_CELLS}
SELECT rowkey, c.family, c.qualifier, c.value, CAST(1 AS BIGINT) AS version FROM cells""",
    "wide_cells_sink": f"""
WITH {_CELLS}
SELECT rowkey, c.family, c.qualifier, c.value, CAST(1 AS BIGINT) AS version FROM cells""",
    "wide_cells_applied": f"""
WITH {_CELLS}
SELECT rowkey, c.family, c.qualifier,
       CASE WHEN c_mktsegment = 'MACHINERY' AND c.qualifier = 'name' THEN 'moved'
            ELSE c.value END AS value,
       CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 1 END AS BIGINT) AS version
FROM cells WHERE c_mktsegment <> 'MACHINERY' OR c_nationkey < 5""",
    "changelog": _CHANGES,
    "changelog_roundtrip": f"WITH {_STATES} SELECT user_id, event_type FROM new",
    "append_changelog": f"""
WITH {_EVENTS}
SELECT true AS is_add, event_id, CAST(user_id AS VARCHAR) AS key,
       CAST(k AS INTEGER) AS value
FROM e""",
    "csv_typed": """
SELECT CAST(c_custkey AS VARCHAR) AS uid, c_nationkey AS age,
       CAST(c_custkey % 2 AS INTEGER) AS sex
FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 11 <> 0""",
    "corrupt_rows": f"""
WITH {_CUSTOMER_LINES}
SELECT value AS _corrupt FROM lines WHERE c_custkey % 10 = 0 OR c_custkey % 11 = 0""",
    "text_lines": f"WITH {_CUSTOMER_LINES} SELECT value FROM lines",
    "catalog_select": """
SELECT c_custkey AS uid, c_name AS name, c_nationkey AS age
FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    "distinct_by_span": f"""
WITH {_EVENTS}
SELECT user_id, COUNT(DISTINCT CASE WHEN k % 7 <> 0 THEN k END) AS values,
       COUNT(DISTINCT event_type) AS types
FROM e WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'
GROUP BY user_id""",
    "running_state": _RUNNING,
    "keyed_totals": _TOTALS,
    "search_documents": f"""
WITH p AS ({_PERFORMANCE})
SELECT user_id AS doc_id, user_id, task_count, course_count,
       CAST(sum_task_type AS INTEGER) AS sum_task_type,
       CAST(sum_creteria_type AS INTEGER) AS sum_creteria_type, sum_time,
       CAST(sum_create AS INTEGER) AS sum_create, CAST(sum_other AS INTEGER) AS sum_other
FROM p""",
    "upsert_snapshot": _LATEST_ROW,
}

# A replay ends with the result of its batch query.
ORACLE_SQL.update(
    {
        "task_performance_replay": _PERFORMANCE,
        "recent_performance_replay": f"""
WITH {_FLAT},
placed AS (
  SELECT flat.*, make_timestamp((epoch_us(proctime) // 43200000000 + 2 - back) * 43200000000)
    AS until
  FROM flat, (VALUES (0), (1)) AS v(back)
)
SELECT user_id, until, {_PERFORMANCE_COLUMNS}
FROM placed GROUP BY user_id, until""",
        "asof_replay": _ASOF,
        "retract_stream_replay": f"""
WITH {_EVENTS},
folded AS (
  SELECT event_id, user_id,
         last_value(event_type IGNORE NULLS) OVER w AS event_type,
         last_value(CASE WHEN k % 7 <> 0 THEN k END IGNORE NULLS) OVER w AS k,
         ts
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
),
steps AS (
  SELECT *, lag(event_type) OVER u AS old_type, lag(k) OVER u AS old_k,
         row_number() OVER u AS place
  FROM folded WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)
),
moves AS (
  SELECT * FROM steps
  WHERE place = 1 OR event_type IS DISTINCT FROM old_type OR k IS DISTINCT FROM old_k
)
SELECT true AS is_add, user_id, event_type, k, event_id FROM moves
UNION ALL SELECT false, user_id, old_type, old_k, event_id FROM moves WHERE place > 1""",
        "membership_windowed_replay": ORACLE_SQL["membership_latest_windowed"],
        "membership_replay": _MEMBERSHIP,
        "membership_changelog_replay": _MEMBERSHIP,
        "tumbling_sum_replay": ORACLE_SQL["tumbling_sum"],
        "window_join_replay": ORACLE_SQL["window_join"],
        "window_left_replay": ORACLE_SQL["window_left"],
        "lookup_replay": _LOOKUP_LEFT,
        "lookup_enrich_replay": _LOOKUP_ENRICH,
        "running_state_replay": _TOTALS,
        "keyed_map_replay": _TOTALS,
        "routed_sinks_replay": ORACLE_SQL["route_counts"],
        "timed_job_replay": ORACLE_SQL["whole_messages"],
    }
)
