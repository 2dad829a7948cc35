"""Registered energy-study queries with their oracles."""

from __future__ import annotations

from tessera.catalog.fixture_sql import r_even, r_up
from tessera.catalog.registry import register
from tessera.plans import energy as EN
from tessera.sources import bindings as B

FEATS = ("power_demand", "nuclear", "gas", "solar", "hydro", "coal", "wind", "spot_price")
ALL = ("datetime",) + FEATS
D = 6  # display digits for means of doubles, whose last bits depend on summation order
SEASON_SQL = """CASE WHEN month(datetime) IN (12, 1, 2) THEN 'Winter' WHEN month(datetime) IN (3, 4, 5) THEN 'Spring'
  WHEN month(datetime) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""


@register("q_energy_weekday_means", "SELECT CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, "
          + ", ".join(f"{r_up(f'avg({c})', D)} AS {c}" for c in FEATS) + " FROM energy GROUP BY 1")
def q_energy_weekday_means(spark, sf):
    return EN.weekday_means(B.energy(spark, sf), digits=D)


@register("q_energy_season", f"""
SELECT {SEASON_SQL} AS season, count(*) AS "rows", {r_up('avg(power_demand)', D)} AS power_demand,
  {r_up('avg(spot_price)', D)} AS spot_price FROM energy GROUP BY 1""")
def q_energy_season(spark, sf):
    return EN.season_summary(B.energy(spark, sf), digits=D)


@register("q_energy_nulls", "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in ALL)
          + ", max(CASE WHEN solar = 0 THEN 1 ELSE 0 END) AS solar_has_zero FROM energy")
def q_energy_nulls(spark, sf):
    return EN.null_report(B.energy(spark, sf))


@register("q_energy_income", "SELECT " + ", ".join(
    f'{r_even(f"sum({q} * spot_price)", 0)} AS "{n}"' for n, q in EN.INCOME_NAMES.items()) + " FROM energy")
def q_energy_income(spark, sf):
    return EN.income(B.energy(spark, sf))


@register("q_energy_hourly", f"""
SELECT CAST(hour(datetime) AS INTEGER) AS hour, {r_up('avg(power_demand)', D)} AS power_demand,
  {r_up('avg(spot_price)', D)} AS spot_price FROM energy GROUP BY 1""")
def q_energy_hourly(spark, sf):
    return EN.hourly_profile(B.energy(spark, sf), digits=D)


@register("q_energy_wind_category", """
WITH c AS (SELECT CASE WHEN wind > 352 AND wind <= 6000 THEN 'low' WHEN wind > 6000 AND wind <= 12000 THEN 'mid'
    WHEN wind > 12000 AND wind <= 17769 THEN 'high' END AS wind_category FROM energy),
n AS (SELECT wind_category, count(*) AS cnt FROM c WHERE wind_category IS NOT NULL GROUP BY 1)
SELECT l.wind_category, coalesce(n.cnt, 0) AS "count", (SELECT min(wind) FROM energy) AS wind_min,
  (SELECT max(wind) FROM energy) AS wind_max
FROM (VALUES ('low'), ('mid'), ('high')) l(wind_category) LEFT JOIN n ON l.wind_category = n.wind_category""")
def q_energy_wind_category(spark, sf):
    return EN.wind_categories(B.energy(spark, sf))


@register("q_energy_extremes", "WITH s AS (SELECT " + ", ".join(f"sum({c}) AS {c}" for c in EN.SOURCES)
          + " FROM energy), l AS (SELECT source, total FROM s UNPIVOT (total FOR source IN ("
          + ", ".join(EN.SOURCES) + f""")))
SELECT (SELECT source FROM l ORDER BY total DESC, source LIMIT 1) AS highest_source, {r_up('max(total)', 2)} AS highest_total,
  (SELECT source FROM l ORDER BY total ASC, source LIMIT 1) AS lowest_source, {r_up('min(total)', 2)} AS lowest_total FROM l""")
def q_energy_extremes(spark, sf):
    return EN.source_extremes(B.energy(spark, sf), digits=2)
