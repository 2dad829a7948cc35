"""Registered generic operators, SURVEY 2.5-2.7: aggregates, windows, sort
and top-k. Each runs on a whole fixture table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.catalog.c_flights import describe_sql
from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.operators import profile, ratios, sorting
from tessera.operators import timeseries as TS
from tessera.operators.selection import exact_quantiles
from tessera.plans import flights as FL
from tessera.plans import wine as WI
from tessera.sources import bindings as B

HR_NUMERIC = ("satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
              "time_spend_company", "Work_accident", "left", "promotion_last_5years")
CRIME_COLS = ("OCCURRED ON", "OCCURRED TO", "UCR CRIME CATEGORY", "PREMISE TYPE", "100 BLOCK ADDR", "ZIP")
WINE_COLS = ("country", "variety", "winery", "province", "price", "points")


def _q(c: str) -> str:
    return '"' + c + '"'


# ---------------------------------------------------------------- 2.5 -----

@register("agg_count_all", "SELECT count(*) AS n_rows, count_if(ArrDelay >= 15) AS n_late FROM delays")
def agg_count_all(spark, sf):
    return B.delays(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("ArrDelay") >= 15).alias("n_late"))


@register("agg_count_group", "SELECT Dest, count(*) AS Total FROM delays GROUP BY Dest")
def agg_count_group(spark, sf):
    return profile.group_counts(B.delays(spark, sf), "Dest")


@register("agg_count_column", 'SELECT "PREMISE TYPE", count("PREMISE TYPE") AS Total FROM crimes GROUP BY 1')
def agg_count_column(spark, sf):
    return profile.group_counts(B.crimes(spark, sf), "PREMISE TYPE", count_col="PREMISE TYPE")


@register("agg_count_if", """
SELECT count_if(ArrDelay >= 15) AS late, count_if(DepDelay > 0) AS dep_late,
  count_if(SecurityDelay IS NOT NULL) AS security_recorded, count_if(WeatherDelay > 0) AS weather FROM delays""")
def agg_count_if(spark, sf):
    return B.delays(spark, sf).agg(
        F.count_if(F.col("ArrDelay") >= 15).alias("late"), F.count_if(F.col("DepDelay") > 0).alias("dep_late"),
        F.count_if(F.col("SecurityDelay").isNotNull()).alias("security_recorded"),
        F.count_if(F.col("WeatherDelay") > 0).alias("weather"))


@register("agg_null_count", "SELECT " + ", ".join(f"CAST(count_if({_q(c)} IS NULL) AS BIGINT) AS {_q(c)}"
                                                  for c in CRIME_COLS) + " FROM crimes")
def agg_null_count(spark, sf):
    return profile.null_counts(B.crimes(spark, sf))


@register("agg_any_null", "SELECT " + ", ".join(f"bool_or({c} IS NULL) AS {c}" for c in WINE_COLS) + " FROM wine")
def agg_any_null(spark, sf):
    return profile.any_null(B.wine(spark, sf))


@register("agg_any_equal", """
SELECT max(CASE WHEN solar = 0 THEN 1 ELSE 0 END) AS solar_any_0, max(CASE WHEN hydro = 0 THEN 1 ELSE 0 END) AS hydro_any_0
FROM energy""")
def agg_any_equal(spark, sf):
    e = B.energy(spark, sf)
    return profile.any_equal(e, "solar", 0).crossJoin(profile.any_equal(e, "hydro", 0))


@register("agg_count_distinct", "SELECT " + ", ".join(f"count(DISTINCT {_q(c)}) AS {_q(c)}" for c in CRIME_COLS)
          + " FROM crimes")
def agg_count_distinct(spark, sf):
    return profile.distinct_counts(B.crimes(spark, sf))


@register("agg_distinct_values", "SELECT DISTINCT salary FROM hr")
def agg_distinct_values(spark, sf):
    return profile.distinct_values(B.hr(spark, sf), "salary")


@register("agg_value_counts", 'SELECT "PREMISE TYPE", count(*) AS "count" FROM crimes WHERE "PREMISE TYPE" IS NOT NULL '
          'GROUP BY 1')
def agg_value_counts(spark, sf):
    return profile.value_counts(B.crimes(spark, sf), "PREMISE TYPE")


@register("agg_mean_group", "SELECT Region, avg(ArrDelay) AS mean_ArrDelay FROM delays GROUP BY Region")
def agg_mean_group(spark, sf):
    return B.delays(spark, sf).groupBy("Region").agg(F.avg("ArrDelay").alias("mean_ArrDelay"))


@register("agg_mean_all_columns", "SELECT salary, " + ", ".join(f"{r_up(f'avg({_q(c)})', 6)} AS {_q(c)}"
                                                               for c in HR_NUMERIC)
          + " FROM hr GROUP BY salary")
def agg_mean_all_columns(spark, sf):
    h = B.hr(spark, sf)
    return h.groupBy("salary").agg(*[F.round(F.avg(c), 6).alias(c) for c in HR_NUMERIC])


@register("agg_multi_mean", "SELECT DayOfWeek, " + ", ".join(
    f"{r_up(f'avg({c})', 2)} AS mean_{c}" for c in ("CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"))
    + " FROM delays GROUP BY DayOfWeek")
def agg_multi_mean(spark, sf):
    d = B.delays(spark, sf)
    return d.groupBy("DayOfWeek").agg(*[F.round(F.avg(c), 2).alias(f"mean_{c}")
                                        for c in ("CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")])


@register("agg_mean_scalar", f"SELECT avg(isAdult) AS adult_share, {r_up('avg(runtimeMinutes)', 6)} AS mean_runtime "
          "FROM titles")
def agg_mean_scalar(spark, sf):
    return B.titles(spark, sf).agg(F.avg("isAdult").alias("adult_share"),
                                   F.round(F.avg("runtimeMinutes"), 6).alias("mean_runtime"))


@register("agg_group_summary", "SELECT country, CAST(count(*) AS BIGINT) AS obs, avg(price) AS average_price, "
          "avg(points) AS average_points FROM wine WHERE price IS NOT NULL AND points IS NOT NULL GROUP BY country")
def agg_group_summary(spark, sf):
    return WI.summary_by(B.wine(spark, sf), "country")


_NUMERIC_DELAYS = ("DayOfWeek", "Distance") + FL.DELAY_COLUMNS


@register("agg_sum_all_numeric", "SELECT Region, " + ", ".join(
    f'CAST(sum({c}) AS BIGINT) AS "sum({c})"' for c in _NUMERIC_DELAYS) + " FROM delays GROUP BY Region")
def agg_sum_all_numeric(spark, sf):
    return B.delays(spark, sf).drop("Origin", "Dest").groupBy("Region").sum()


@register("agg_sum_columns", f"""
SELECT sum(gas) AS gas, sum(hydro) AS hydro, sum(coal) AS coal, {r_up('sum(nuclear)', 4)} AS nuclear,
  round_even(sum(coal * spot_price), 0) AS coal_income FROM energy""")
def agg_sum_columns(spark, sf):
    e = B.energy(spark, sf)
    return e.agg(F.sum("gas").alias("gas"), F.sum("hydro").alias("hydro"), F.sum("coal").alias("coal"),
                 F.round(F.sum("nuclear"), 4).alias("nuclear"),
                 F.bround(F.sum(F.col("coal") * F.col("spot_price")), 0).alias("coal_income"))


@register("agg_min_max", "SELECT min(wind) AS wind_min, max(wind) AS wind_max, min(solar) AS solar_min, "
          "max(solar) AS solar_max FROM energy")
def agg_min_max(spark, sf):
    return B.energy(spark, sf).agg(F.min("wind").alias("wind_min"), F.max("wind").alias("wind_max"),
                                   F.min("solar").alias("solar_min"), F.max("solar").alias("solar_max"))


@register("agg_argmin_argmax_columns", """
WITH s AS (SELECT sum(gas) AS gas, sum(hydro) AS hydro, sum(coal) AS coal FROM energy),
l AS (SELECT source, total FROM s UNPIVOT (total FOR source IN (gas, hydro, coal)))
SELECT (SELECT source FROM l ORDER BY total DESC, source LIMIT 1) AS highest_source, max(total) AS highest_total,
  (SELECT source FROM l ORDER BY total ASC, source LIMIT 1) AS lowest_source, min(total) AS lowest_total FROM l""")
def agg_argmin_argmax_columns(spark, sf):
    return ratios.extreme_column(B.energy(spark, sf), ["gas", "hydro", "coal"])


@register("agg_corr_group", f"""
SELECT Dest, {r_up('c', 2)} AS carrier_late FROM (SELECT Dest, corr(CarrierDelay, LateAircraftDelay) AS c
  FROM delays GROUP BY Dest) WHERE c IS NOT NULL AND NOT isnan(c)""")
def agg_corr_group(spark, sf):
    return ratios.corr_by(B.delays(spark, sf), "Dest", {"carrier_late": ("CarrierDelay", "LateAircraftDelay")})


@register("agg_stddev", f"""
SELECT series_id, {r_up('stddev_samp(value)', 9)} AS sd_sample, {r_up('stddev_pop(value)', 9)} AS sd_population
FROM series GROUP BY series_id""")
def agg_stddev(spark, sf):
    s = B.series(spark, sf)
    return s.groupBy("series_id").agg(F.round(F.stddev_samp("value"), 9).alias("sd_sample"),
                                      F.round(F.stddev_pop("value"), 9).alias("sd_population"))


@register("agg_median", f"SELECT series_id, {r_up('median(value)', 9)} AS median FROM series GROUP BY series_id")
def agg_median(spark, sf):
    """Median per series, exact for any series length (no series in one task)."""
    q = exact_quantiles(B.series(spark, sf), "value", [0.5], ["series_id"])
    return q.select("series_id", F.round("value", 9).alias("median"))


@register("agg_describe", "\nUNION ALL ".join(describe_sql("hr", c, None) for c in HR_NUMERIC))
def agg_describe(spark, sf):
    return profile.describe(B.hr(spark, sf), HR_NUMERIC, digits=6)


@register("agg_pivot", """
SELECT sales, min(CASE WHEN salary = 'low' THEN average_montly_hours END) AS low,
  min(CASE WHEN salary = 'medium' THEN average_montly_hours END) AS medium,
  min(CASE WHEN salary = 'high' THEN average_montly_hours END) AS high FROM hr GROUP BY sales""")
def agg_pivot(spark, sf):
    return ratios.pivot_value(B.hr(spark, sf), "sales", "salary", ["low", "medium", "high"],
                              "average_montly_hours", "min")


@register("agg_crosstab_share", 'SELECT ZIP, "UCR CRIME CATEGORY", count(*) AS "count" FROM crimes GROUP BY 1, 2')
def agg_crosstab_share(spark, sf):
    return B.crimes(spark, sf).groupBy("ZIP", "UCR CRIME CATEGORY").count()


# ---------------------------------------------------------------- 2.6 -----

@register("win_series_slice", "SELECT * FROM series WHERE t <= 30")
def win_series_slice(spark, sf):
    return TS.slice_first(B.series(spark, sf), 30)


@register("win_diff", """
SELECT series_id, CAST(t - 1 AS INTEGER) AS t, value - lag(value) OVER (PARTITION BY series_id ORDER BY t) AS value
FROM series QUALIFY t > 1""")
def win_diff(spark, sf):
    return TS.difference(B.series(spark, sf))


@register("win_share_of_total", f"""
SELECT Region, count(*) AS flights, {r_up('count(*) / sum(count(*)) OVER () * 100', 2)} AS pct
FROM delays GROUP BY Region""")
def win_share_of_total(spark, sf):
    g = B.delays(spark, sf).groupBy("Region").agg(F.count(F.lit(1)).alias("flights"))
    # a window without partition, over the aggregated rows only (one per region)
    total = F.sum("flights").over(Window.partitionBy())
    return g.select("Region", "flights", F.round(F.col("flights") / total * 100, 2).alias("pct"))


# ---------------------------------------------------------------- 2.7 -----

@register("sort_single", "SELECT Dest, count(*) AS Total FROM delays GROUP BY Dest ORDER BY Total DESC, Dest")
def sort_single(spark, sf):
    return profile.group_counts(B.delays(spark, sf), "Dest").orderBy(F.col("Total").desc(), "Dest")


@register("sort_multi", """
SELECT country, CAST(count(*) AS BIGINT) AS obs, avg(price) AS average_price, avg(points) AS average_points
FROM wine WHERE price IS NOT NULL AND points IS NOT NULL GROUP BY country
ORDER BY obs DESC, average_price DESC""")
def sort_multi(spark, sf):
    return WI.summary_by(B.wine(spark, sf), "country").orderBy(F.col("obs").desc(), F.col("average_price").desc())


@register("sort_by_derived", """
SELECT variety, CAST(count(*) AS BIGINT) AS obs FROM wine WHERE price IS NOT NULL AND points IS NOT NULL
GROUP BY variety ORDER BY -obs""")
def sort_by_derived(spark, sf):
    return WI.summary_by(B.wine(spark, sf), "variety").select("variety", "obs").orderBy(-F.col("obs"))


@register("limit_n", "SELECT * FROM hr ORDER BY id LIMIT 20")
def limit_n(spark, sf):
    return sorting.top_k(B.hr(spark, sf), [F.col("id").asc()], 20)


@register("topk_least_frequent", """
SELECT ZIP, count(*) AS Total FROM crimes GROUP BY ZIP ORDER BY Total ASC, ZIP ASC NULLS LAST LIMIT 10""")
def topk_least_frequent(spark, sf):
    return profile.least_frequent(B.crimes(spark, sf), "ZIP", 10)


@register("topk_most_frequent", """
SELECT ZIP, count(*) AS Total FROM crimes GROUP BY ZIP ORDER BY Total DESC, ZIP ASC NULLS LAST LIMIT 10""")
def topk_most_frequent(spark, sf):
    return profile.most_frequent(B.crimes(spark, sf), "ZIP", 10)


@register("first_extreme", """
WITH a AS (SELECT "100 BLOCK ADDR" AS v, count(*) AS n FROM crimes GROUP BY 1)
SELECT (SELECT v FROM a ORDER BY n ASC, v ASC NULLS LAST LIMIT 1) AS "least_100 BLOCK ADDR",
  (SELECT n FROM a ORDER BY n ASC, v ASC NULLS LAST LIMIT 1) AS "least_100 BLOCK ADDR_Total",
  (SELECT v FROM a ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) AS "most_100 BLOCK ADDR",
  (SELECT n FROM a ORDER BY n DESC, v ASC NULLS LAST LIMIT 1) AS "most_100 BLOCK ADDR_Total" """)
def first_extreme(spark, sf):
    return profile.extremes(B.crimes(spark, sf), ["100 BLOCK ADDR"])


@register("head_tail", """
(SELECT 'head' AS part, * FROM hr ORDER BY id LIMIT 5) UNION ALL (SELECT 'tail' AS part, * FROM hr ORDER BY id DESC LIMIT 5)""")
def head_tail(spark, sf):
    h = B.hr(spark, sf)
    return (sorting.head(h, "id", 5).select(F.lit("head").alias("part"), "*")
            .unionByName(sorting.tail(h, "id", 5).select(F.lit("tail").alias("part"), "*")))
