"""Registered flight-study queries with their oracles."""

from __future__ import annotations

from tessera.catalog.fixture_sql import r_even, r_up
from tessera.catalog.registry import register
from tessera.plans import flights as FL
from tessera.sources import bindings as B

CAT = """CASE WHEN Distance >= 93 AND Distance <= 500 THEN '1.Very Short'
  WHEN Distance > 500 AND Distance <= 1100 THEN '2.Short'
  WHEN Distance > 1100 AND Distance <= 1700 THEN '3.Medium' ELSE '4.Long' END"""

_RATIO_SQL = ",\n  ".join(
    f"{r_even(f'd.n_{c} / t.Total_flights', 3)} AS {FL.RATIO_NAMES[c]}" for c in FL.DELAY_COLUMNS)
_N_SQL = ",\n  ".join(f"sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END) AS n_{c}" for c in FL.DELAY_COLUMNS)


@register("q_region_delay_proportions", f"""
WITH t AS (SELECT Region, count(*) AS Total_flights FROM delays GROUP BY Region),
d AS (SELECT Region, {_N_SQL}
  FROM delays
  WHERE DepDelay > 0 OR CarrierDelay > 0 OR WeatherDelay > 0 OR NASDelay > 0
     OR SecurityDelay > 0 OR LateAircraftDelay > 0
  GROUP BY Region)
SELECT t.Region, {_RATIO_SQL}
FROM t JOIN d ON t.Region = d.Region""")
def q_region_delay_proportions(spark, sf):
    return FL.region_delay_proportions(B.delays(spark, sf))


def _security_sql(col: str) -> str:
    return f"""
SELECT {col}, count({col}) AS NumFlights,
  {r_up(f'count(SecurityDelay) / (SELECT count(*) FROM delays) * 100', 2)} AS Ratio
FROM delays WHERE SecurityDelay IS NOT NULL GROUP BY {col}
ORDER BY Ratio DESC, NumFlights DESC, {col} ASC NULLS LAST LIMIT 10"""


@register("q_security_by_origin", _security_sql("Origin"))
def q_security_by_origin(spark, sf):
    return FL.security_by_airport(B.delays(spark, sf), "Origin")


@register("q_security_by_dest", _security_sql("Dest"))
def q_security_by_dest(spark, sf):
    return FL.security_by_airport(B.delays(spark, sf), "Dest")


_PAIRS = [(a, b) for i, a in enumerate(FL.COOCCURRENCE_COLUMNS) for b in FL.COOCCURRENCE_COLUMNS[i + 1:]]
_COOC_SQL = ",\n  ".join(
    f'CAST(count_if({a} >= 15 AND {b} >= 15) AS BIGINT) AS "{FL.SHORT_NAMES[a]}-{FL.SHORT_NAMES[b]}"'
    for a, b in _PAIRS)


@register("q_delay_cooccurrence", f"SELECT {_COOC_SQL} FROM delays")
def q_delay_cooccurrence(spark, sf):
    return FL.delay_cooccurrence(B.delays(spark, sf))


@register("q_delay_corr_by_airport", f"""
SELECT Origin, {r_up('c1', 2)} AS carrier_nas, {r_up('c2', 2)} AS nas_late
FROM (SELECT Origin, corr(CarrierDelay, NASDelay) AS c1, corr(NASDelay, LateAircraftDelay) AS c2
      FROM delays GROUP BY Origin)
WHERE c1 IS NOT NULL AND NOT isnan(c1) AND c2 IS NOT NULL AND NOT isnan(c2)""")
def q_delay_corr_by_airport(spark, sf):
    return FL.delay_corr_by_airport(B.delays(spark, sf))


def describe_sql(source: str, col: str, by: str | None, digits: int = 6) -> str:
    """Long describe ``(by, column, stat, value)`` in SQL, rounded like the Spark side."""
    x = f'CAST("{col}" AS DOUBLE)'
    key = f"{by}, " if by else ""
    stats = {"count": f"CAST(count({x}) AS DOUBLE)", "mean": f"avg({x})", "std": f"stddev_samp({x})",
             "min": f"min({x})", "25%": f"quantile_cont({x}, 0.25)", "50%": f"quantile_cont({x}, 0.5)",
             "75%": f"quantile_cont({x}, 0.75)", "max": f"max({x})"}
    sel = ", ".join(f'{r_up(e, digits)} AS "{s}"' for s, e in stats.items())
    names = ", ".join(f'"{s}"' for s in stats)
    return f"""SELECT {key}'{col}' AS "column", stat, value FROM (
  SELECT {key}{sel} FROM {source} {'GROUP BY ' + by if by else ''}
) UNPIVOT INCLUDE NULLS (value FOR stat IN ({names}))"""


@register("q_distance_summary", "WITH base AS (SELECT 'all' AS subset, Distance FROM delays UNION ALL "
          "SELECT 'delayed' AS subset, Distance FROM delays WHERE ArrDelay >= 15)\n"
          + describe_sql("base", "Distance", "subset"))
def q_distance_summary(spark, sf):
    return FL.distance_summary(B.delays(spark, sf), digits=6)


@register("q_flights_by_distance_category", f"""
SELECT {CAT} AS Distance_Category, count(*) AS "#Flights" FROM delays GROUP BY 1""")
def q_flights_by_distance_category(spark, sf):
    return FL.flights_by_distance_category(B.delays(spark, sf))


@register("q_delayed_ratio_by_distance", f"""
SELECT Distance_Category, count_if(ArrDelay >= 15) AS "#DelayedFlights",
  {r_up('count_if(ArrDelay >= 15) / count(*) * 100', 1)} AS Ratio
FROM (SELECT *, {CAT} AS Distance_Category FROM delays) GROUP BY Distance_Category""")
def q_delayed_ratio_by_distance(spark, sf):
    return FL.delayed_ratio_by_distance(B.delays(spark, sf))


_CAUSE_UNION = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS cause, Distance_Category, count(*) AS NumFlights, avg(ArrDelay) AS a "
    f"FROM late WHERE {c} > 0 GROUP BY Distance_Category" for c in FL.CAUSES)


@register("q_cause_by_distance", f"""
WITH late AS (SELECT *, {CAT} AS Distance_Category FROM delays WHERE ArrDelay >= 15),
per AS ({_CAUSE_UNION})
SELECT cause, Distance_Category, NumFlights, {r_up('a', 1)} AS "AvgDelay(min)",
  {r_up('NumFlights / sum(NumFlights) OVER (PARTITION BY cause) * 100', 1)} AS Ratio
FROM per""")
def q_cause_by_distance(spark, sf):
    return FL.cause_by_distance(B.delays(spark, sf))


@register("q_flights_by_weekday", 'SELECT DayOfWeek, count(*) AS "count" FROM delays GROUP BY DayOfWeek')
def q_flights_by_weekday(spark, sf):
    return FL.flights_by_weekday(B.delays(spark, sf))


_WK = "CASE WHEN DayOfWeek IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END"


@register("q_weekend_delay_rate", f"""
SELECT {_WK} AS Weekend,
  {r_up('100 * avg(CASE WHEN ArrDelay >= 15 THEN 1 ELSE 0 END)', 1)} AS "Percentage Delayed"
FROM delays GROUP BY 1""")
def q_weekend_delay_rate(spark, sf):
    return FL.weekend_delay_rate(B.delays(spark, sf))


_NW = ",\n  ".join(f'{r_up(f"avg({c})", 2)} AS "{n}"' for c, n in FL.NONWEATHER_NAMES.items())


@register("q_nonweather_weekend_means", f"""
SELECT {_WK} AS Weekend, {_NW}
FROM delays WHERE ArrDelay >= 15 AND WeatherDelay = 0 GROUP BY 1""")
def q_nonweather_weekend_means(spark, sf):
    return FL.nonweather_weekend_means(B.delays(spark, sf))


_HAUL = """h AS (SELECT th.threshold,
    CASE WHEN Distance >= th.threshold THEN 'Long' ELSE 'Short' END AS Long_Short_Haul, DepDelay, ArrDelay
  FROM delays, (VALUES (1700), (1100)) th(threshold))"""


@register("q_delay_recovery", f"""
WITH {_HAUL}
SELECT threshold, Long_Short_Haul, Num, Num / total * 100 AS percentage_of_flights_with_recovered_delays
FROM (SELECT threshold, Long_Short_Haul, count_if(DepDelay > 0 AND ArrDelay <= DepDelay) AS Num,
        count(*) AS total FROM h GROUP BY 1, 2)
WHERE Num > 0""")
def q_delay_recovery(spark, sf):
    return FL.delay_recovery(B.delays(spark, sf))


@register("q_delay_recovery_asis", f"""
WITH {_HAUL},
s AS (SELECT threshold, count(*) AS short_total FROM h WHERE Long_Short_Haul = 'Short' GROUP BY 1)
SELECT g.threshold, Long_Short_Haul, Num, Num / short_total * 100 AS percentage_of_flights_with_recovered_delays
FROM (SELECT threshold, Long_Short_Haul,
        count_if(DepDelay > 0 AND CAST(ArrDelay AS VARCHAR) <= CAST(DepDelay AS VARCHAR)) AS Num
      FROM h GROUP BY 1, 2) g JOIN s ON g.threshold = s.threshold
WHERE Num > 0""")
def q_delay_recovery_asis(spark, sf):
    return FL.delay_recovery(B.delays(spark, sf), as_is=True)
