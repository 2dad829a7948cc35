"""Registered scalar functions, SURVEY 2.9, each applied to a whole fixture table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.fixture_sql import r_even, r_up
from tessera.catalog.registry import register
from tessera.functions import columns as C
from tessera.plans import energy as EN
from tessera.plans import flights as FL
from tessera.plans import hr as HRP
from tessera.plans import wine as WI
from tessera.sources import bindings as B



@register("fn_round_half_up", f"SELECT DepDelay, {r_up('DepDelay / 4', 1)} AS r FROM delays")
def fn_round_half_up(spark, sf):
    d = B.delays(spark, sf)
    return d.select("DepDelay", C.round_half_up(F.col("DepDelay") / 4, 1).alias("r"))


@register("fn_round_half_even", f"SELECT DepDelay, {r_even('DepDelay / 4', 1)} AS r FROM delays")
def fn_round_half_even(spark, sf):
    d = B.delays(spark, sf)
    return d.select("DepDelay", C.round_half_even(F.col("DepDelay") / 4, 1).alias("r"))


@register("fn_percent", "SELECT Origin, count_if(ArrDelay >= 15) / count(*) * 100 AS pct_late FROM delays GROUP BY Origin")
def fn_percent(spark, sf):
    g = B.delays(spark, sf).groupBy("Origin").agg(F.count_if(F.col("ArrDelay") >= 15).alias("n"),
                                                  F.count(F.lit(1)).alias("t"))
    return g.select("Origin", C.percent("n", "t").alias("pct_late"))


@register("fn_ln", f"SELECT price, {r_up('ln(price)', 10)} AS ln_price FROM wine WHERE price IS NOT NULL")
def fn_ln(spark, sf):
    w = B.wine(spark, sf).where(F.col("price").isNotNull())
    return w.select("price", F.round(F.ln("price"), 10).alias("ln_price"))


@register("fn_log10", f"SELECT price, {r_up('log10(price)', 10)} AS log10_price FROM wine WHERE price IS NOT NULL")
def fn_log10(spark, sf):
    w = B.wine(spark, sf).where(F.col("price").isNotNull())
    return w.select("price", F.round(F.log10("price"), 10).alias("log10_price"))


@register("fn_square", "SELECT series_id, t, value * value AS value FROM series")
def fn_square(spark, sf):
    from tessera.operators import timeseries as TS
    return TS.squared(B.series(spark, sf))


@register("fn_normal_pdf", f"""
WITH s AS (SELECT series_id, avg(value) AS mu, stddev_samp(value) AS sigma FROM series GROUP BY series_id)
SELECT x.series_id, x.t, {r_up('exp(-0.5 * pow((x.value - mu) / sigma, 2)) / (sigma * sqrt(2 * pi()))', 12)} AS density
FROM series x JOIN s ON x.series_id = s.series_id""")
def fn_normal_pdf(spark, sf):
    s = B.series(spark, sf)
    st = s.groupBy("series_id").agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sigma"))
    return s.join(st, "series_id").select(
        "series_id", "t", F.round(C.normal_pdf("value", F.col("mu"), F.col("sigma")), 12).alias("density"))


@register("fn_grid", f"""
WITH s AS (SELECT series_id, min(value) AS lo, max(value) AS hi FROM series GROUP BY series_id)
SELECT series_id, CAST(i AS INTEGER) AS i, {r_up('lo + i * (hi - lo) / 99', 9)} AS x FROM s, range(100) r(i)""")
def fn_grid(spark, sf):
    from tessera.operators import distributions as D
    s = B.series(spark, sf).groupBy("series_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    g = D.grid(s, F.col("lo"), F.col("hi"), 100)
    return g.select("series_id", "i", F.round("x", 9).alias("x"))


@register("fn_word_count", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INTEGER) AS words "
          "FROM documents")
def fn_word_count(spark, sf):
    """Words of whole documents (up to 20,000 words each), by the title word rule (T23)."""
    from tessera.sources.io import read_table
    d = read_table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.word_count("text").alias("words"))


@register("fn_to_timestamp_utc", "SELECT CAST(datetime AS VARCHAR) AS text, CAST(CAST(datetime AS VARCHAR) AS TIMESTAMP) AS parsed FROM energy")
def fn_to_timestamp_utc(spark, sf):
    # the whole wall-clock text of a timestamp_ntz, with its fraction if it has one (date_format would
    # pass through the session time zone)
    e = B.energy(spark, sf).select(F.col("datetime").cast("string").alias("text"))
    return e.select("text", C.to_timestamp_utc("text", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").alias("parsed"))


@register("fn_calendar_parts", """
SELECT datetime, CAST(day(datetime) AS INTEGER) AS day, CAST(month(datetime) AS INTEGER) AS month,
  CAST(year(datetime) AS INTEGER) AS year, CAST(hour(datetime) AS INTEGER) AS hour,
  CAST(isodow(datetime) - 1 AS INTEGER) AS weekday FROM energy""")
def fn_calendar_parts(spark, sf):
    return C.calendar(B.energy(spark, sf).select("datetime"), "datetime")


@register("fn_weekend_flag", "SELECT datetime, isodow(datetime) - 1 > 4 AS weekend FROM energy")
def fn_weekend_flag(spark, sf):
    e = B.energy(spark, sf)
    return e.select("datetime", C.weekend_flag(F.weekday("datetime")).alias("weekend"))


@register("fn_weekend_label", "SELECT DayOfWeek, CASE WHEN DayOfWeek IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END "
          "AS Weekend FROM delays")
def fn_weekend_label(spark, sf):
    return B.delays(spark, sf).select("DayOfWeek", C.weekend_label("DayOfWeek").alias("Weekend"))


@register("fn_season", """
SELECT datetime, CASE WHEN month(datetime) IN (12, 1, 2) THEN 'Winter' WHEN month(datetime) IN (3, 4, 5) THEN 'Spring'
  WHEN month(datetime) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM energy""")
def fn_season(spark, sf):
    return B.energy(spark, sf).select("datetime", C.season(F.month("datetime")).alias("season"))


@register("fn_delayed_flag", "SELECT ArrDelay, CASE WHEN ArrDelay >= 15 THEN 1 ELSE 0 END AS Delayed FROM delays")
def fn_delayed_flag(spark, sf):
    return B.delays(spark, sf).select("ArrDelay", FL.delayed_flag().alias("Delayed"))


@register("fn_distance_category", """
SELECT Distance, CASE WHEN Distance >= 93 AND Distance <= 500 THEN '1.Very Short'
  WHEN Distance > 500 AND Distance <= 1100 THEN '2.Short' WHEN Distance > 1100 AND Distance <= 1700 THEN '3.Medium'
  ELSE '4.Long' END AS Distance_Category FROM delays""")
def fn_distance_category(spark, sf):
    return B.delays(spark, sf).select("Distance", FL.distance_category().alias("Distance_Category"))


@register("fn_haul_class", """
SELECT Distance, CASE WHEN Distance >= 1700 THEN 'Long' ELSE 'Short' END AS haul_1700,
  CASE WHEN Distance >= 1100 THEN 'Long' ELSE 'Short' END AS haul_1100 FROM delays""")
def fn_haul_class(spark, sf):
    return B.delays(spark, sf).select("Distance", FL.haul_class("Distance", 1700).alias("haul_1700"),
                                      FL.haul_class("Distance", 1100).alias("haul_1100"))


@register("fn_severity_map", """
SELECT "UCR CRIME CATEGORY", CASE "UCR CRIME CATEGORY" WHEN '1-URGENT' THEN '4.EXTREME' WHEN '2-HIGH' THEN '3.MAJOR'
  WHEN '3-MEDIUM' THEN '2.INTERMEDIATE' ELSE '1.MINOR' END AS "CRIME SEVERITY" FROM crimes""")
def fn_severity_map(spark, sf):
    c = B.crimes(spark, sf)
    return c.select("UCR CRIME CATEGORY",
                    C.map_values("UCR CRIME CATEGORY", B.CRIME_SEVERITY, "1.MINOR").alias("CRIME SEVERITY"))


@register("fn_price_category", """
SELECT price, CASE WHEN price <= 20 THEN 'cheap' WHEN price > 15 AND price <= 50 THEN 'premium'
  WHEN price > 50 AND price <= 200 THEN 'luxury' ELSE 'iconic' END AS price_category FROM wine""")
def fn_price_category(spark, sf):
    return B.wine(spark, sf).select("price", WI.price_category().alias("price_category"))


@register("fn_cut_right", """
SELECT wind, CASE WHEN wind > 352 AND wind <= 6000 THEN 'low' WHEN wind > 6000 AND wind <= 12000 THEN 'mid'
  WHEN wind > 12000 AND wind <= 17769 THEN 'high' END AS wind_category FROM energy""")
def fn_cut_right(spark, sf):
    e = B.energy(spark, sf)
    return e.select("wind", C.cut_right("wind", EN.WIND_EDGES, EN.WIND_LABELS).alias("wind_category"))


def _disc_sql(col: str) -> str:
    bins, names = HRP.DISCRETIZE[col]
    parts = []
    for i, ((lo, hi), name) in enumerate(zip(bins, names)):
        low = f"{col} >= {lo}" if i == 0 else f"{col} > {lo}"
        parts.append(f"WHEN {low} AND {col} <= {hi} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" END AS {col}"


@register("fn_discretize", "SELECT id, " + ", ".join(_disc_sql(c) for c in HRP.DISCRETIZE) + " FROM hr")
def fn_discretize(spark, sf):
    h = B.hr(spark, sf)
    return h.select("id", *[C.discretize(c, *HRP.DISCRETIZE[c]).alias(c) for c in HRP.DISCRETIZE])
