"""Registered wine-study queries with their oracles."""

from __future__ import annotations

from tessera.catalog.registry import register
from tessera.plans import wine as WI
from tessera.sources import bindings as B

# Subsets and group thresholds for the wine binding (FIXTURES.md, wine).
COUNTRIES = ("LARGE", "MEDIUM", "PROMO", "SMALL")
VARIETIES = ("red plate", "small widget", "hot plate", "hot ring", "large rod", "old rod")
MIN_OBS = {"country": 300, "variety": 30}
CLEAN = "(SELECT *, 1 AS one, ln(price) AS ln_price FROM wine WHERE price IS NOT NULL AND points IS NOT NULL)"


def _in(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


@register("q_wine_price_category", f"""
SELECT CASE WHEN price <= 20 THEN 'cheap' WHEN price > 15 AND price <= 50 THEN 'premium'
  WHEN price > 50 AND price <= 200 THEN 'luxury' ELSE 'iconic' END AS price_category, count(*) AS n
FROM {CLEAN} GROUP BY 1""")
def q_wine_price_category(spark, sf):
    return WI.price_category_counts(B.wine(spark, sf))


@register("q_wine_group_summaries", "\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, CAST(sum(one) AS BIGINT) AS obs, avg(price) AS average_price, "
    f"avg(points) AS average_points FROM {CLEAN} GROUP BY {d}" for d in WI.DIMENSIONS))
def q_wine_group_summaries(spark, sf):
    return WI.group_summaries(B.wine(spark, sf))


@register("q_wine_top_subsets", f"""
SELECT 'countries' AS subset, country, variety, winery, province, price, points FROM {CLEAN}
  WHERE country IN ({_in(COUNTRIES)})
UNION ALL SELECT 'varieties', country, variety, winery, province, price, points FROM {CLEAN}
  WHERE variety IN ({_in(VARIETIES)})
UNION ALL SELECT 'countries_varieties', country, variety, winery, province, price, points FROM {CLEAN}
  WHERE country IN ({_in(COUNTRIES)}) AND variety IN ({_in(VARIETIES)})""")
def q_wine_top_subsets(spark, sf):
    return WI.top_subsets(B.wine(spark, sf), COUNTRIES, VARIETIES)


@register("q_wine_frequent_groups", "\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, CAST(count(*) AS BIGINT) AS obs FROM {CLEAN} GROUP BY {d} "
    f"HAVING count(*) > {m}" for d, m in MIN_OBS.items()))
def q_wine_frequent_groups(spark, sf):
    from pyspark.sql import functions as F
    w = B.wine(spark, sf)
    parts = [WI.frequent_groups(w, d, m).select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "obs")
             for d, m in MIN_OBS.items()]
    return parts[0].unionByName(parts[1])
