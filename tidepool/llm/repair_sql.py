"""DuckDB SQL for the repair of damaged conversations.

The damage, faults and cheapest edits of ``repair.damaged_repair`` by another way: a
recursive query that walks the rows of every conversation and keeps, for each last
role, the least (cost, audit, repaired text) that reaches it.
"""

from __future__ import annotations


def _add(x, cost, letter, text="''"):
    return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': {x}.t || {text}}} END"


def _least(*options):
    return f"list_min([{', '.join(options)}])"


def repair_sql():
    u, a = "'user:' || chr(10)", "'assistant:' || chr(10)"
    relax = {2: _least("v2", *[_add(f"v{i}", 5, "I", u) for i in (0, 1, 3)]), 3: "list_min([v3, " + _add("r2", 5, "I", a) + "])"}
    own, stay = "role || ':' || text || chr(10)", "CASE WHEN code >= 8 THEN 5 ELSE 0 END"
    as_u, as_a = "'user:' || text || chr(10)", "'assistant:' || text || chr(10)"

    def if_(cond, x):
        return f"CASE WHEN {cond} THEN {x} END"

    free, kind = "code & 4 = 0", "code & 3"
    to_u = [f"r{i}" for i in (0, 1, 3)]
    step = {
        0: _add("r0", 2, "D"),
        1: _least(_add("r1", 2, "D"), if_(f"{free} AND {kind} = 0", _add("r0", stay, "K", own))),
        2: _least(_add("r2", 2, "D"), *[if_(free, _add(x, f"1 + {stay}", "R", as_u)) for x in to_u],
                  *[if_(f"{free} AND {kind} = 1", _add(x, stay, "K", own)) for x in to_u]),
        3: _least(_add("r3", 2, "D"), if_(free, _add("r2", f"1 + {stay}", "R", as_a)),
                  if_(f"{free} AND {kind} = 2", _add("r2", stay, "K", own)))}
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS o_role, coalesce(text, ' ') AS o_text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
fated AS (
  SELECT conv_id, turn, o_role, o_text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS fate
  FROM named, tab),
damaged AS (
  SELECT conv_id, turn, o_role, o_text, unnest(range(CASE WHEN fate = 0 THEN 0 WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy,
         CASE WHEN fate = 4 THEN 'user' ELSE o_role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(o_text, '.!?', '') ELSE o_text END AS text FROM fated),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, o_role, o_text, copy) AS rn FROM damaged),
coded AS (
  SELECT conv_id, rn, turn, role, text, body = '' AS blank,
         CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS kind,
         CASE WHEN body = '' OR again > 1 THEN 4 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 8 ELSE 0 END AS fault
  FROM (SELECT *, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS again FROM numbered)),
step AS (SELECT *, kind + fault AS code, lag(kind) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM coded),
dp(conv_id, seen, v0, v1, v2, v3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 't': ''}}, {none}, {none}, {none} FROM conversations
  UNION ALL
  SELECT conv_id, rn, {step[0]}, {step[1]}, {step[2]}, {step[3]}
  FROM (SELECT *, v0 AS r0, v1 AS r1, {relax[3]} AS r3
        FROM (SELECT dp.*, s.rn, s.role, s.text, s.code, {relax[2]} AS r2
              FROM dp JOIN step s ON s.conv_id IS NOT DISTINCT FROM dp.conv_id AND s.rn = dp.seen + 1))),
done AS (
  SELECT conv_id, list_min([v0, {relax[3]}]) AS best
  FROM (SELECT *, {relax[2]} AS r2 FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY seen DESC) = 1)),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE fault = 4 AND NOT blank) AS duplicate, count(*) FILTER (WHERE fault = 8) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND NOT (kind = before + 1 AND kind < 3 OR before = 2 AND kind = 1)) AS illegal
  FROM step GROUP BY conv_id)
SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(left(best.t, greatest(length(best.t) - 1, 0))) AS repaired_sha256
FROM done LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM done.conv_id
"""
