"""DuckDB definitions of the stand-in logical tables (mirror of
``clinicflow.sources.standins``), written independently as SQL.

``with_standins(body)`` prefixes a query with the CTEs it references.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    "visit": """
  SELECT o_orderkey AS vn,
         o_custkey AS hn,
         CAST(o_orderdate AS TIMESTAMP) + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS created_at,
         o_orderpriority <> '4-NOT SPECIFIED' AS active,
         CASE WHEN o_orderkey % 20 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS deleted_at,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'pending' END
           AS latest_status_code,
         CASE WHEN o_orderkey % 9 = 0 THEN CAST([] AS BIGINT[]) ELSE [o_custkey % 8] END
           AS insurance_plan_ids,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              WHEN o_orderkey % 13 = 0 THEN CAST([] AS BIGINT[])
              WHEN o_orderkey % 17 = 0 THEN [o_custkey % 25, NULL]
              WHEN o_orderkey % 3 = 0 THEN [o_custkey % 25, o_orderkey % 25, o_custkey % 25]
              ELSE [o_custkey % 25, o_orderkey % 25] END AS department_ids,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              WHEN o_orderkey % 13 = 0 THEN CAST([] AS BIGINT[])
              WHEN o_orderkey % 17 = 0 THEN [o_custkey % n.c, NULL]
              WHEN o_orderkey % 3 = 0 THEN [o_custkey % n.c, (o_orderkey * 7) % n.c, o_custkey % n.c]
              ELSE [o_custkey % n.c, (o_orderkey * 7) % n.c] END AS clinic_ids
  FROM orders, (SELECT count(*) AS c FROM supplier) n""",
    "encounter": """
  SELECT l_orderkey AS vn,
         l_orderkey * 8 + l_linenumber AS en,
         min(l_suppkey) AS clinic_id,
         CAST(min(l_shipdate) AS TIMESTAMP) AS created_at,
         CASE WHEN min(l_linestatus) = 'F'
              THEN CAST(max(l_shipdate) AS TIMESTAMP)
                   + to_minutes(CAST(min(l_partkey) % 480 AS INTEGER)) + INTERVAL 30 SECOND
         END AS completed_at,
         CASE WHEN min(l_returnflag) = 'R' THEN CAST(max(l_shipdate) AS TIMESTAMP) END AS deleted_at
  FROM lineitem
  GROUP BY l_orderkey, l_linenumber""",
    "queue": """
  SELECT event_id AS en, CAST(ts AS TIMESTAMP) AS called_at FROM events""",
    "appointment": """
  SELECT event_id AS id,
         CAST(ts AS TIMESTAMP) AS "start",
         user_id AS patient_hn,
         event_id % 120 AS clinic_id,
         user_id AS practitioner_id,
         event_type AS service_type,
         CASE event_id % 3 WHEN 0 THEN 'booked' WHEN 1 THEN 'fulfilled' ELSE 'cancelled' END AS current_status,
         CASE WHEN event_id % 17 = 0 THEN CAST(ts AS TIMESTAMP) END AS deleted_at
  FROM events""",
    "dx_visit": """
  SELECT event_id AS vn,
         user_id AS hn,
         ts AS created_at,
         TRUE AS active,
         CASE WHEN event_id % 25 = 0 THEN ts END AS deleted_at,
         CASE WHEN event_id % 6 = 0 THEN 'open' ELSE 'completed' END AS latest_status_code,
         CASE WHEN event_id % 23 = 0 THEN NULL
              WHEN event_id % 29 = 0 THEN chr(10) || '[' || item || ']'
              WHEN event_id % 31 = 0 THEN '[1,' || item || ']'
              WHEN event_id % 37 = 0 THEN '[' || item || ',[1]]'
              WHEN event_id % 41 = 0 THEN item
              WHEN event_id % 43 = 0 THEN '[' || item
              WHEN event_id % 47 = 0 THEN chr(9) || ' ["s",' || item || ']'
              WHEN event_id % 5 = 0 THEN '[]'
              WHEN event_id % 2 = 0 THEN CAST(to_json([
                  {'code': CASE WHEN k % 10 <> 0 THEN 'C' || CAST(k AS VARCHAR) END, 'display': 'dx ' || CAST(k AS VARCHAR)},
                  {'code': CASE WHEN j % 10 <> 0 THEN 'C' || CAST(j AS VARCHAR) END, 'display': 'dx ' || CAST(j AS VARCHAR)}])
                AS VARCHAR)
              ELSE CAST(to_json([
                  {'code': CASE WHEN k % 10 <> 0 THEN 'C' || CAST(k AS VARCHAR) END, 'display': 'dx ' || CAST(k AS VARCHAR)}])
                AS VARCHAR)
         END AS diagnosis
  FROM (SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, k, (k * 7 + event_id) % 100 AS j,
               CAST(to_json({'code': CASE WHEN k % 10 <> 0 THEN 'C' || CAST(k AS VARCHAR) END, 'display': 'dx ' || CAST(k AS VARCHAR)})
                 AS VARCHAR) AS item
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))""",
    "department": """
  SELECT CAST(n_nationkey AS BIGINT) AS id,
         n_name AS name,
         n_regionkey <> 4 AS active,
         CASE WHEN n_nationkey = 7 THEN TIMESTAMP '2020-01-01 00:00:00' END AS deleted_at
  FROM nation""",
    "clinic": """
  SELECT s_suppkey AS id, s_name AS name FROM supplier""",
    "practitioner": """
  SELECT c_custkey AS id, c_name AS display FROM customer""",
    "patient": """
  SELECT c_custkey AS hn,
         CASE c_custkey % 7 WHEN 0 THEN 'Male' WHEN 1 THEN 'm' WHEN 2 THEN '1' WHEN 3 THEN 'FEMALE'
              WHEN 4 THEN 'หญิง' WHEN 5 THEN NULL ELSE 'other' END AS gender,
         c_name AS patient_name
  FROM customer""",
    "insurance_plan": """
  SELECT CAST(id AS BIGINT) AS id, code AS nhso_insurance_plan_category_code, name
  FROM (VALUES (0, 'UCS', 'Universal'), (1, 'SSS', 'Social'), (2, 'OFC', 'Officer'),
               (3, 'LGO', 'Local'), (4, NULL, 'เงินสด'), (5, NULL, 'เงินสด เบิกได้'),
               (6, NULL, 'Other'), (7, 'XXX', 'Foreign')) t(id, code, name)""",
    "cashier": """
  SELECT o_orderkey AS vn,
         o_custkey AS hn,
         CASE o_orderstatus WHEN 'F' THEN 'OPD' WHEN 'O' THEN 'IPD' END AS patient_type,
         CASE WHEN o_orderkey % 2 = 0 THEN 'AT' ELSE 'ET' END AS visit_time,
         o_orderpriority AS insurance_name,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DECIMAL(20,2))
              ELSE CAST(o_totalprice AS DECIMAL(20,2)) END AS amount
  FROM orders""",
}



def with_standins(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <used stand-ins>, <extra ctes> <body>``.

    A body that starts with its own ``WITH`` has those CTEs appended after ours.
    """
    extra = extra or {}
    own = None
    m = re.match(r"\s*WITH\s+", body, flags=re.IGNORECASE)
    if m:
        own, body = body[m.end():], None
    text = (own or body) + " ".join(extra.values())
    used = [n for n in CTES if re.search(rf"\b{n}\b", text)]
    parts = [f"{n} AS ({CTES[n]}\n)" for n in used]
    parts += [f"{n} AS ({sql}\n)" for n, sql in extra.items()]
    if own is not None:
        return "WITH " + ",\n".join(parts + [own])
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
