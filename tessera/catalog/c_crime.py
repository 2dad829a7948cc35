"""Registered crime-study queries with their oracles."""

from __future__ import annotations

from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.plans import crime as CR
from tessera.sources import bindings as B

PROFILE_K = {"OCCURRED ON": 5, "OCCURRED TO": 5, "UCR CRIME CATEGORY": 5, "PREMISE TYPE": 5,
             "ZIP": 10, "100 BLOCK ADDR": 10}
SEV_SQL = """CASE "UCR CRIME CATEGORY" WHEN '1-URGENT' THEN '4.EXTREME' WHEN '2-HIGH' THEN '3.MAJOR'
  WHEN '3-MEDIUM' THEN '2.INTERMEDIATE' ELSE '1.MINOR' END"""


def _q(name: str) -> str:
    return '"' + name + '"'


_CASTS = ", ".join(f"CAST({_q(c)} AS VARCHAR) AS {_q(c)}" for c in PROFILE_K)
_NAMES = ", ".join(_q(c) for c in PROFILE_K)
_KVALUES = ", ".join(f"('{c}', {k})" for c, k in PROFILE_K.items())


@register("q_profile_columns", f"""
WITH v AS (SELECT {_CASTS} FROM crimes),
lng AS (SELECT "column", value FROM v UNPIVOT INCLUDE NULLS (value FOR "column" IN ({_NAMES}))),
counts AS (SELECT "column", value, count(*) AS total FROM lng GROUP BY "column", value),
kk AS (SELECT * FROM (VALUES {_KVALUES}) t("column", k)),
ranked AS (SELECT c."column", c.value, c.total, kk.k,
    row_number() OVER (PARTITION BY c."column" ORDER BY c.total ASC, c.value ASC NULLS LAST) AS rl,
    row_number() OVER (PARTITION BY c."column" ORDER BY c.total DESC, c.value ASC NULLS LAST) AS rm
  FROM counts c JOIN kk ON c."column" = kk."column")
SELECT "column", 'nulls' AS kind, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS VARCHAR) AS value,
  CAST(sum(CASE WHEN value IS NULL THEN total ELSE 0 END) AS BIGINT) AS total FROM counts GROUP BY "column"
UNION ALL SELECT "column", 'distinct', NULL, NULL, count(value) FROM counts GROUP BY "column"
UNION ALL SELECT "column", 'least', CAST(rl AS INTEGER), value, total FROM ranked WHERE rl <= k
UNION ALL SELECT "column", 'most', CAST(rm AS INTEGER), value, total FROM ranked WHERE rm <= k""")
def q_profile_columns(spark, sf):
    return CR.profile_columns(B.crimes(spark, sf), PROFILE_K)


@register("q_earliest_rows", """
SELECT * FROM crimes ORDER BY "OCCURRED ON" ASC NULLS LAST, "OCCURRED TO" ASC NULLS LAST,
  "UCR CRIME CATEGORY" ASC NULLS LAST, "PREMISE TYPE" ASC NULLS LAST, "100 BLOCK ADDR" ASC NULLS LAST,
  ZIP ASC NULLS LAST LIMIT 10""")
def q_earliest_rows(spark, sf):
    return CR.earliest_rows(B.crimes(spark, sf))


def _extreme_sql(col: str, alias: str) -> tuple[str, str]:
    cte = f'{alias} AS (SELECT {_q(col)} AS v, count(*) AS n FROM crimes GROUP BY 1)'
    sel = (f'(SELECT v FROM {alias} ORDER BY n ASC, v ASC NULLS LAST LIMIT 1) AS "least_{col}", '
           f'(SELECT n FROM {alias} ORDER BY n ASC, v ASC NULLS LAST LIMIT 1) AS "least_{col}_Total", '
           f'(SELECT v FROM {alias} ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) AS "most_{col}", '
           f'(SELECT n FROM {alias} ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) AS "most_{col}_Total"')
    return cte, sel


_E1, _E2 = _extreme_sql("UCR CRIME CATEGORY", "a"), _extreme_sql("PREMISE TYPE", "b")


@register("q_extreme_categories", f"WITH {_E1[0]}, {_E2[0]} SELECT {_E1[1]}, {_E2[1]}")
def q_extreme_categories(spark, sf):
    return CR.extreme_categories(B.crimes(spark, sf))


@register("q_category_ratio", f"""
SELECT "UCR CRIME CATEGORY", count("UCR CRIME CATEGORY") AS "NUM CRIMES",
  {r_up('count("UCR CRIME CATEGORY") / (SELECT count(*) FROM crimes) * 100', 1)} AS "ROUNDED RATIO"
FROM crimes GROUP BY 1""")
def q_category_ratio(spark, sf):
    return CR.category_ratio(B.crimes(spark, sf))


@register("q_severity_ratio", f"""
SELECT {SEV_SQL} AS "CRIME SEVERITY", count(*) AS "NUM CRIMES",
  {r_up('count(*) / (SELECT count(*) FROM crimes) * 100', 1)} AS "ROUNDED RATIO"
FROM crimes GROUP BY 1""")
def q_severity_ratio(spark, sf):
    return CR.severity_ratio(B.crimes(spark, sf), B.CRIME_SEVERITY)


@register("q_top20_premises", f"""
SELECT "PREMISE TYPE", count("PREMISE TYPE") AS "NUM CRIMES/PREMISE",
  {r_up('count("PREMISE TYPE") / (SELECT count(*) FROM crimes) * 100', 1)} AS RATIO
FROM crimes WHERE "PREMISE TYPE" <> 'OTHER' GROUP BY 1
ORDER BY "NUM CRIMES/PREMISE" DESC, "PREMISE TYPE" ASC NULLS LAST LIMIT 20""")
def q_top20_premises(spark, sf):
    return CR.top_premises(B.crimes(spark, sf))


@register("q_premise_totals", """
SELECT "PREMISE TYPE", count("PREMISE TYPE") AS TotalPremise FROM crimes GROUP BY 1""")
def q_premise_totals(spark, sf):
    return CR.premise_totals(B.crimes(spark, sf))


_ZIP = f"""sev AS (SELECT *, {SEV_SQL} AS "CRIME SEVERITY" FROM crimes),
tot AS (SELECT ZIP, count(ZIP) AS TotalCrimes FROM crimes GROUP BY ZIP),
s AS (SELECT ZIP, "CRIME SEVERITY", count("CRIME SEVERITY") AS "NUM CRIME SEVERITY" FROM sev
      WHERE "CRIME SEVERITY" <> '1.MINOR' AND "CRIME SEVERITY" <> '2.INTERMEDIATE' GROUP BY 1, 2),
z AS (SELECT s.ZIP, "CRIME SEVERITY", "NUM CRIME SEVERITY", TotalCrimes,
    {r_up('"NUM CRIME SEVERITY" / TotalCrimes * 100', 2)} AS "SEVERITY BY ZIP RATIO"
  FROM s JOIN tot ON s.ZIP = tot.ZIP WHERE TotalCrimes >= 5)"""


@register("q_zip_severity", f"""
WITH {_ZIP}
SELECT * FROM z ORDER BY "NUM CRIME SEVERITY" DESC, ZIP DESC, "CRIME SEVERITY" ASC LIMIT 100""")
def q_zip_severity(spark, sf):
    return CR.top_zip_severity(B.crimes(spark, sf), mapping=B.CRIME_SEVERITY)


@register("q_zip_severity_pivot", f"""
WITH {_ZIP}
SELECT ZIP, min(CASE WHEN "CRIME SEVERITY" = '3.MAJOR' THEN "SEVERITY BY ZIP RATIO" END) AS "3.MAJOR",
  min(CASE WHEN "CRIME SEVERITY" = '4.EXTREME' THEN "SEVERITY BY ZIP RATIO" END) AS "4.EXTREME"
FROM z GROUP BY ZIP
ORDER BY "4.EXTREME" DESC NULLS LAST, "3.MAJOR" DESC NULLS LAST, ZIP ASC LIMIT 40""")
def q_zip_severity_pivot(spark, sf):
    return CR.zip_severity_pivot(B.crimes(spark, sf), mapping=B.CRIME_SEVERITY)
