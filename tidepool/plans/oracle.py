"""DuckDB SQL for each registered query, on the driver tables as views."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

HOT_ITEMS = """
WITH v AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts
  FROM events WHERE event_type = 'view'),
w AS (
  SELECT item_id, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL (5 * k) MINUTE AS window_end
  FROM v, generate_series(1, 12) AS g(k)),
c AS (SELECT item_id, window_end, count(*) AS view_count FROM w GROUP BY item_id, window_end),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rn FROM c)
SELECT window_end, CAST(rn AS INTEGER) AS rank, item_id, view_count FROM r WHERE rn <= 5
"""

ORACLE["hot_items"] = HOT_ITEMS

ORACLE["hot_items_report"] = f"""
WITH t AS ({HOT_ITEMS})
SELECT window_end,
  '====================================' || chr(10) || 'time: ' ||
  strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.' || CAST(CAST(microsecond(window_end) / 100000 AS INTEGER) AS VARCHAR) || chr(10) ||
  string_agg('No' || rank || ':  item=' || item_id || '  views=' || view_count, chr(10) ORDER BY rank) ||
  chr(10) || '====================================' || chr(10) || chr(10) AS report
FROM t GROUP BY window_end
"""

_TOKENS = "string_split_regex(lower(text), '\\W+')"

ORACLE["word_count"] = f"""
SELECT word, count(*) AS count
FROM (SELECT unnest({_TOKENS}) AS word FROM documents)
WHERE length(word) > 0 GROUP BY word
"""

ORACLE["word_count_text"] = f"""
SELECT '(' || word || ',' || count || ')' AS line FROM ({ORACLE['word_count']})
"""

ORACLE["ws_word_count"] = """
WITH s AS (
  SELECT CASE WHEN text = '' THEN ['']
              WHEN regexp_replace(text, '\\s+$', '') = '' THEN []::VARCHAR[]
              ELSE string_split_regex(regexp_replace(text, '\\s+$', ''), '\\s') END AS parts
  FROM conversations)
SELECT word, count(*) AS count FROM (SELECT unnest(parts) AS word FROM s) GROUP BY word
"""

ORACLE["running_count"] = f"""
WITH s AS (SELECT conv_id, turn, {_TOKENS} AS parts FROM conversations),
t AS (SELECT conv_id, turn, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos,
             unnest(parts) AS word FROM s)
SELECT conv_id, turn, pos, word,
       count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos ROWS UNBOUNDED PRECEDING) AS running_count
FROM t WHERE length(word) > 0
"""

ORACLE["word_count_window"] = f"""
WITH s AS (SELECT doc_id, {_TOKENS} AS parts FROM documents),
t AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS word FROM s),
n AS (SELECT word, row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS rn
      FROM t WHERE length(word) > 0),
w AS (SELECT word, rn, count(*) OVER (PARTITION BY word ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
      FROM n)
SELECT word, rn AS fire_seq, CAST(c AS BIGINT) AS window_sum, c AS n_rows FROM w WHERE rn % 3 = 0
"""

ORACLE["tumbling_sum"] = """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       round(sum(value), 2) AS value_sum, count(*) AS n
FROM events GROUP BY ALL
"""

ORACLE["sliding_sum"] = """
SELECT event_type, window_end - INTERVAL '150 minutes' AS window_start, window_end,
       round(sum(value), 2) AS value_sum, count(*) AS n
FROM (SELECT event_type, value,
             time_bucket(INTERVAL '30 minutes', ts) + INTERVAL (30 * k) MINUTE AS window_end
      FROM events, generate_series(1, 5) AS g(k))
GROUP BY ALL
"""

ORACLE["sliding_count"] = """
SELECT event_type, window_end - INTERVAL '20 minutes' AS window_start, window_end,
       round(sum(value), 2) AS value_sum, count(*) AS n
FROM (SELECT event_type, value,
             time_bucket(INTERVAL '10 minutes', ts) + INTERVAL (10 * k) MINUTE AS window_end
      FROM events, generate_series(1, 2) AS g(k))
GROUP BY ALL
"""

ORACLE["tumbling_min_row"] = """
SELECT event_type, window_start, window_start + INTERVAL '1 hour' AS window_end,
       event_id, ts, user_id, value
FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start,
             row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL '1 hour', ts)
                                ORDER BY value, ts, event_id) AS rn
      FROM events)
WHERE rn = 1
"""

ORACLE["user_sessions"] = """
WITH e AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL '30 minutes'
                 THEN 1 ELSE 0 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end,
       first(event_type ORDER BY ts, event_id) AS first_event_type,
       round(sum(value), 2) AS value_sum, count(*) AS n
FROM s GROUP BY user_id, sid
"""

_EV_RN = """
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
"""

ORACLE["count_window_sum"] = f"""
WITH e AS ({_EV_RN}),
w AS (SELECT user_id, rn, ts,
             sum(value) OVER f AS s, count(*) OVER f AS c
      FROM e WINDOW f AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT user_id, rn AS fire_seq, round(s, 2) AS window_sum, c AS n_rows, ts FROM w WHERE rn % 3 = 0
"""

ORACLE["every_n_average"] = """
WITH l AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
           FROM lineitem),
g AS (SELECT l_orderkey, (rn - 1) // 2 + 1 AS group_no, sum(q) AS s, count(*) AS c FROM l GROUP BY ALL)
SELECT l_orderkey, group_no, CAST(s // 2 AS BIGINT) AS average FROM g WHERE c = 2
"""

ORACLE["every_n_average_events"] = f"""
WITH e AS ({_EV_RN}),
g AS (SELECT user_id, (rn - 1) // 3 + 1 AS group_no,
             sum(CAST(round(value * 100) AS BIGINT)) AS s, count(*) AS c FROM e GROUP BY ALL)
SELECT user_id, group_no, CAST(s // 3 AS BIGINT) AS average FROM g WHERE c = 3
"""

ORACLE["full_batches"] = f"""
WITH e AS ({_EV_RN}),
b AS (SELECT *, (rn - 1) // 10 + 1 AS batch_no, (rn - 1) % 10 + 1 AS slot FROM e),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, batch_no) AS sz FROM b)
SELECT user_id, batch_no, slot, event_id, ts, value FROM c WHERE sz = 10
"""

ORACLE["delta_trigger_max"] = """
WITH RECURSIVE e AS (
  SELECT user_id, event_id, ts, value,
         row_number() OVER w AS rn,
         sum(CAST(round(value * 100) AS BIGINT)) OVER (w ROWS UNBOUNDED PRECEDING) AS pos
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
walk(user_id, rn, mark, fired) AS (
  SELECT user_id, rn, pos, false FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.pos - walk.mark > 50000 THEN e.pos ELSE walk.mark END,
         e.pos - walk.mark > 50000
  FROM walk JOIN e ON e.user_id = walk.user_id AND e.rn = walk.rn + 1),
f AS (SELECT e.* FROM walk JOIN e USING (user_id, rn) WHERE walk.fired),
c AS (SELECT f.user_id, f.event_id AS fire_event_id, f.ts AS fire_ts,
             x.event_id, x.ts, x.value, x.pos,
             row_number() OVER (PARTITION BY f.user_id, f.rn ORDER BY x.value DESC, x.rn) AS k
      FROM f JOIN e x ON x.user_id = f.user_id AND x.rn <= f.rn
                     AND x.ts > f.ts - INTERVAL '1 day')
SELECT user_id, fire_ts, fire_event_id, event_id, ts, value, CAST(pos AS BIGINT) AS pos FROM c WHERE k = 1
"""

ORACLE["user_aggregate"] = """
WITH b AS (
  SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS window_start, CAST(floor(value) AS BIGINT) AS bin, count(*) AS n
  FROM events WHERE value IS NOT NULL GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY event_type, window_start ORDER BY bin) AS high,
         sum(n) OVER (PARTITION BY event_type, window_start) AS total FROM b),
k AS (
  SELECT *, greatest(0, least(high, total - total * 10 // 100) - greatest(high - n, total * 10 // 100)) AS kept FROM c)
SELECT event_type, window_start, window_start + INTERVAL '1 day' AS window_end, CAST(total AS BIGINT) AS n,
       CAST(sum(bin * kept) AS DOUBLE) / CAST(sum(kept) AS DOUBLE) AS trimmed_mean
FROM k GROUP BY event_type, window_start, total
"""

ORACLE["whole_window_median"] = """
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       count(*) AS n, quantile_disc(value, 0.5) AS median
FROM events GROUP BY ALL
"""

ORACLE["json_decimal"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS transaction_time,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(38, 18)) AS VARCHAR) AS transaction_amount
FROM orders
"""

ORACLE["parse_tuples"] = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice
FROM orders
"""

ORACLE["key_number_lines"] = """
SELECT c_name AS name, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS BIGINT) END AS number FROM customer
"""

ORACLE["marked_lines"] = """
SELECT event_type = 'error' AS is_marker, epoch_us(ts) // 1000 AS t_ms, user_id, value FROM events
"""

ORACLE["broadcast_lookup"] = """
SELECT c.c_custkey, c.c_nationkey, n.n_name,
       CAST(c.c_nationkey AS VARCHAR) || ' ---> ' || coalesce(n.n_name, 'null') AS line
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

ORACLE["lookup_last_wins"] = """
WITH d AS (SELECT o_custkey, last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS o_orderstatus
           FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, d.o_orderstatus FROM customer c LEFT JOIN d ON c.c_custkey = d.o_custkey
"""

ORACLE["json_project"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
"""

ORACLE["json_attach"] = """
SELECT event_id, CAST(json(props) AS VARCHAR) AS json FROM events
"""

ORACLE["counted_rows"] = "SELECT * FROM orders"

ORACLE["tumbling_max_row"] = """
SELECT event_type, window_start, window_start + INTERVAL '1 hour' AS window_end,
       event_id, ts, user_id, value
FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS window_start,
             row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL '1 hour', ts)
                                ORDER BY value DESC, ts, event_id) AS rn
      FROM events)
WHERE rn = 1
"""

ORACLE["punctuated_min_row"] = """
WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN ts END AS mark FROM events),
w AS (SELECT *, max(mark) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm_before,
             time_bucket(INTERVAL '1 hour', ts) AS ws FROM e),
ok AS (SELECT * FROM w
       WHERE wm_before IS NULL OR wm_before < ws + INTERVAL '1 hour' - INTERVAL '1 millisecond'),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, ws ORDER BY value, ts, event_id) AS rn FROM ok),
fin AS (SELECT max(mark) AS fwm FROM e)
SELECT event_type, ws AS window_start, ws + INTERVAL '1 hour' AS window_end, event_id, ts, user_id, value
FROM r, fin WHERE rn = 1 AND ws + INTERVAL '1 hour' - INTERVAL '1 millisecond' <= fwm
"""

ORACLE["counted_total"] = "SELECT count(*) AS num_lines FROM orders"

ORACLE["json_attach_broken"] = """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(json(props) AS VARCHAR) END AS json FROM events
"""

ORACLE["json_rejects"] = """
SELECT event_id, substr(props, 1, length(props) - 1) AS props FROM events WHERE event_id % 10 = 0
"""

ORACLE["tuple_text_nulls"] = """
SELECT '(' || o_orderkey || ',' || CASE WHEN o_orderstatus = 'O' THEN 'O' ELSE 'null' END || ',' || o_custkey || ')' AS line
FROM orders
"""

ORACLE["sliding_uneven"] = """
SELECT event_type, window_start, window_start + INTERVAL '50 minutes' AS window_end,
       count(*) AS n, min(value) AS low, max(value) AS high
FROM (SELECT event_type, value, ts, time_bucket(INTERVAL '20 minutes', ts, TIMESTAMP '1970-01-01') - INTERVAL (20 * k) MINUTE AS window_start
      FROM events, generate_series(0, 2) AS g(k))
WHERE ts < window_start + INTERVAL '50 minutes'
GROUP BY ALL
"""
