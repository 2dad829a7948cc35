"""The FIXTURES.md derivations in DuckDB SQL, for the oracle side.

``with_fixtures(sql)`` prepends, as CTEs, the study tables a query names.
Helpers ``r_up``/``r_even`` round like Spark's ``round``/``bround`` on a
double: Spark rounds the decimal text of the double (``1.005`` -> 1.01), so
the oracle parses the double's text into a wide decimal before rounding (T12).
"""

from __future__ import annotations

import re

FIXTURES: dict[str, str] = {
    "delays": """
SELECT cn.n_name AS Origin, sn.n_name AS Dest, rg.r_name AS Region,
  CAST(isodow(l_shipdate) AS INTEGER) AS DayOfWeek,
  CAST(p_size * 50 AS INTEGER) AS Distance,
  CAST(arr AS INTEGER) AS ArrDelay,
  CAST(arr + l_linenumber * 10 - 50 AS INTEGER) AS DepDelay,
  CAST(CASE WHEN arr >= 15 THEN greatest(CAST(round(l_discount * 100) AS INTEGER) - 5, 0) * 6 END AS INTEGER) AS CarrierDelay,
  CAST(CASE WHEN arr >= 15 THEN greatest(CAST(round(l_tax * 100) AS INTEGER) - 4, 0) * 8 END AS INTEGER) AS NASDelay,
  CAST(CASE WHEN arr >= 15 THEN CASE WHEN l_linenumber = 7 THEN CAST(l_quantity AS INTEGER) ELSE 0 END END AS INTEGER) AS SecurityDelay,
  CAST(CASE WHEN arr >= 15 THEN greatest(CAST(l_quantity AS INTEGER) - 25, 0) END AS INTEGER) AS LateAircraftDelay,
  CAST(CASE WHEN arr >= 15 THEN CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey % 40 AS INTEGER) ELSE 0 END END AS INTEGER) AS WeatherDelay
FROM (SELECT *, date_diff('day', o_orderdate, l_shipdate) % 120 AS arr
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON cn.n_nationkey = c_nationkey
JOIN nation sn ON sn.n_nationkey = s_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') rg ON cn.n_regionkey = r_regionkey""",
    "crimes": """
SELECT o_orderdate AS "OCCURRED ON",
  CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate + INTERVAL '1' DAY END AS "OCCURRED TO",
  o_orderpriority AS "UCR CRIME CATEGORY",
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'OTHER' ELSE c_mktsegment END AS "PREMISE TYPE",
  c_name AS "100 BLOCK ADDR",
  CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS "ZIP"
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "energy": """
SELECT ts + (event_id % 360) * INTERVAL '1' DAY AS datetime,
  value * 50 AS power_demand,
  value * 12 AS nuclear,
  CAST((user_id + 1) * 10 AS DOUBLE) AS gas,
  CASE WHEN event_type <> 'view' THEN value * 3 END AS solar,
  CAST(event_id % 97 AS DOUBLE) AS hydro,
  CAST((event_id % 53) * 2 AS DOUBLE) AS coal,
  CASE WHEN event_id % 100 = 0 THEN CAST(352 AS DOUBLE) ELSE value * 36 END AS wind,
  CAST(event_id % 71 AS DOUBLE) + 0.5 AS spot_price
FROM events""",
    "titles": """
SELECT source AS titleType,
  CASE WHEN d.doc_id % 31 <> 0 THEN text END AS primaryTitle,
  CAST(coalesce(toxic, 0) AS INTEGER) AS isAdult,
  CAST(2019 AS INTEGER) AS startYear,
  CASE WHEN d.doc_id % 9 <> 0 THEN CAST(n_chars AS DOUBLE) / 50 END AS runtimeMinutes
FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id""",
    "wine": """
SELECT CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS country,
  p_name AS variety, p_brand AS winery,
  concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) AS province,
  CASE WHEN p_partkey % 11 <> 0 THEN CAST((p_partkey * 37) % 400 + 1 AS DOUBLE) END AS price,
  CAST(CASE WHEN p_partkey % 13 <> 0 THEN 80 + p_size % 21 END AS INTEGER) AS points
FROM part""",
    "hr": """
SELECT o_orderkey AS id,
  CAST((o_orderkey * 37) % 92 + 9 AS DOUBLE) / 100 AS satisfaction_level,
  CAST((o_orderkey * 53) % 65 + 36 AS DOUBLE) / 100 AS last_evaluation,
  CAST(2 + o_orderkey % 6 AS INTEGER) AS number_project,
  CAST(96 + (o_orderkey * 71) % 215 AS INTEGER) AS average_montly_hours,
  CAST(2 + CASE WHEN o_custkey % 40 = 0 THEN 8 ELSE o_custkey % 3 END AS INTEGER) AS time_spend_company,
  CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS Work_accident,
  CASE WHEN o_custkey % 47 = 0 THEN 1 ELSE 0 END AS promotion_last_5years,
  CASE o_custkey % 10 WHEN 0 THEN 'sales' WHEN 1 THEN 'technical' WHEN 2 THEN 'support' WHEN 3 THEN 'IT'
    WHEN 4 THEN 'hr' WHEN 5 THEN 'RandD' WHEN 6 THEN 'marketing' WHEN 7 THEN 'accounting'
    WHEN 8 THEN 'product_mng' ELSE 'management' END AS sales,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'high'
    WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'medium' ELSE 'low' END AS salary,
  CASE WHEN (o_orderkey * 37) % 92 < 36 AND (o_orderkey % 6 = 0 OR o_totalprice > 250000) THEN 1 ELSE 0 END AS "left"
FROM orders""",
    "hr_predictions": """
SELECT id, "left" AS label, CASE WHEN satisfaction_level < 0.45 THEN 1 ELSE 0 END AS prediction FROM hr""",
    "series": """
SELECT user_id AS series_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS t,
  value
FROM events""",
    "series_walk": """
SELECT series_id, t, sum(value - 49.6) OVER (PARTITION BY series_id ORDER BY t
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM series""",
}

_DEPENDS = {"hr_predictions": ("hr",), "series_walk": ("series",)}
_ORDER = ("delays", "crimes", "energy", "titles", "wine", "hr", "hr_predictions", "series", "series_walk")


def with_fixtures(sql: str) -> str:
    """Prepend the fixture CTEs the query mentions (by whole word)."""
    need: set[str] = set()
    for name in _ORDER:
        if re.search(rf"\b{name}\b", sql):
            need.add(name)
            need.update(_DEPENDS.get(name, ()))
    if not need:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n].strip()})" for n in _ORDER if n in need)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def r_up(expr: str, digits: int) -> str:
    """Spark ``round`` (half up on the decimal form) of a double expression."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def r_even(expr: str, digits: int) -> str:
    """Spark ``bround`` (half even on the decimal form) of a double expression."""
    return f"CAST(round_even(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"
