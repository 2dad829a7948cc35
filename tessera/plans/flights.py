"""Flight delay study: six questions over one flights table.

Input columns: ``Origin, Dest, Region, DayOfWeek (1 = Monday), Distance,
ArrDelay, DepDelay`` and the five cause columns, integers, null when missing.
Where the reference runs one job per class or per cause, each
function here is one scan and one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.functions.predicates import any_of
from tessera.operators import profile, ratios
from tessera.session import stored

# Fixed values of the study.
CAUSES = ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
DELAY_COLUMNS = ("ArrDelay", "DepDelay") + CAUSES
RATIO_NAMES = {"ArrDelay": "ratio_ArrD", "DepDelay": "ratio_DepD", "CarrierDelay": "ratio_CarrierD",
               "WeatherDelay": "ratio_WeaD", "NASDelay": "ratio_NASD", "SecurityDelay": "ratio_SecD",
               "LateAircraftDelay": "ratio_LateACD"}
# Co-occurrence pairs are taken in this column order, with these short names.
COOCCURRENCE_COLUMNS = ("CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "WeatherDelay")
SHORT_NAMES = {"CarrierDelay": "Ca", "NASDelay": "NAS", "SecurityDelay": "Sec",
               "LateAircraftDelay": "Late", "WeatherDelay": "Wea"}
LATE_MINUTES = 15
DISTANCE_CLASSES = (("1.Very Short", 93, 500), ("2.Short", 500, 1100), ("3.Medium", 1100, 1700))
DISTANCE_OTHER = "4.Long"
HAUL_THRESHOLDS = (1700, 1100)


def distance_category(distance: Column | str = "Distance") -> Column:
    """Four classes; the first is closed on both ends, the others right-closed;
    everything else, short distances below 93 and null included, is ``4.Long`` (T8)."""
    d = C.col_of(distance)
    expr = None
    for i, (name, lo, hi) in enumerate(DISTANCE_CLASSES):
        cond = ((d >= lo) if i == 0 else (d > lo)) & (d <= hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(DISTANCE_OTHER))


def haul_class(distance: Column | str = "Distance", threshold: int = 1700) -> Column:
    """``Long`` at or above the threshold, else ``Short``."""
    return F.when(C.col_of(distance) >= threshold, F.lit("Long")).otherwise(F.lit("Short"))


def delayed_flag(arr: Column | str = "ArrDelay", minutes: int = LATE_MINUTES) -> Column:
    """1 when the arrival is late by ``minutes`` or more, else 0 (null too)."""
    return F.when(C.col_of(arr) >= minutes, F.lit(1)).otherwise(F.lit(0))


# ------------------------------------------------------------------ Q1 -----

def region_delay_proportions(flights: DataFrame, region: str = "Region", digits: int = 3) -> DataFrame:
    """Share of a region's flights with each kind of delay.

    A flight counts for a delay kind when that delay is > 0 and the flight has
    any delay other than a pure arrival delay (T4: the reference's second
    filter tests the 0/1 arrival flag against 15, so that term never holds).
    The region total counts all its flights. Regions without such flights and
    the null region drop out, as the reference's inner join does (T6). One
    ``groupBy`` replaces two aggregates and a join.
    """
    others = [c for c in DELAY_COLUMNS if c != "ArrDelay"]
    eff = any_of(*[F.col(c) > 0 for c in others])
    aggs = [F.count(F.lit(1)).alias("Total_flights"), F.count_if(eff).alias("_delayed")]
    aggs += [F.count_if(eff & (F.col(c) > 0)).alias("_n_" + c) for c in DELAY_COLUMNS]
    g = flights.groupBy(region).agg(*aggs)
    return (g.where(F.col(region).isNotNull() & (F.col("_delayed") > 0))
            .select(region, *[F.bround(F.try_divide(F.col("_n_" + c).cast("double"),
                                                    F.col("Total_flights").cast("double")), digits)
                              .alias(RATIO_NAMES[c]) for c in DELAY_COLUMNS]))


# ------------------------------------------------------------------ Q2 -----

def security_by_airport(flights: DataFrame, airport: str = "Origin", k: int = 10,
                        cause: str = "SecurityDelay", present: str = "not_null") -> DataFrame:
    """Airports with the most security-delay reports as % of all flights.

    ``present='not_null'`` counts rows where the cause is recorded at all
    (T7, as the reference); ``'positive'`` counts rows where it is > 0.
    Output ``airport, NumFlights, Ratio`` top ``k`` by Ratio, ties by count
    then airport.
    """
    cond = F.col(cause).isNotNull() if present == "not_null" else (F.col(cause) > 0)
    shares = ratios.share_by(flights, airport, where=cond, count_col=airport, denominator="all",
                             name="NumFlights", pct_name="Ratio", digits=2)
    return shares.orderBy(F.col("Ratio").desc(), F.col("NumFlights").desc(),
                          F.col(airport).asc_nulls_last()).limit(k)


# ------------------------------------------------------------------ Q3 -----

def delay_cooccurrence(flights: DataFrame, cols: Sequence[str] = COOCCURRENCE_COLUMNS,
                       threshold: int = LATE_MINUTES) -> DataFrame:
    """How often two causes reach ``threshold`` together, one column per pair."""
    return ratios.cooccurrence(flights, cols, threshold, names=SHORT_NAMES)


def delay_corr_by_airport(flights: DataFrame, airport: str = "Origin") -> DataFrame:
    """Carrier~NAS and NAS~late-aircraft correlation by airport, rounded to 2.

    The reference names the first pair ``Carrier-LateAircraft`` but computes
    Carrier~NAS (T9); the name here says what it is.
    """
    return ratios.corr_by(flights, airport, {"carrier_nas": ("CarrierDelay", "NASDelay"),
                                             "nas_late": ("NASDelay", "LateAircraftDelay")})


# ------------------------------------------------------------------ Q4 -----

def distance_summary(flights: DataFrame, method: str = "exact", digits: int | None = None) -> DataFrame:
    """``summary()`` of Distance for delayed flights and for all.

    Output ``(subset, column, stat, value)``. The flights are read once and
    the two values a row needs written: moments and the rounds of the exact
    quartiles read those. Each row is counted for ``all`` and, when late, for
    ``delayed``.
    """
    late = stored(flights.select("Distance", F.coalesce(F.col("ArrDelay") >= LATE_MINUTES, F.lit(False)).alias("_late")))
    subsets = F.when(F.col("_late"), F.array(F.lit("all"), F.lit("delayed"))).otherwise(F.array(F.lit("all")))
    tagged = late.select(F.explode(subsets).alias("subset"), "Distance")
    return profile.describe(tagged, ["Distance"], method=method, by="subset", digits=digits)


def flights_by_distance_category(flights: DataFrame) -> DataFrame:
    """Flights per distance class."""
    return (flights.withColumn("Distance_Category", distance_category())
            .groupBy("Distance_Category").agg(F.count("Distance_Category").alias("#Flights")))


def delayed_ratio_by_distance(flights: DataFrame, digits: int = 1) -> DataFrame:
    """Delayed flights and their % of the class, per class: one aggregate for four jobs."""
    late = F.col("ArrDelay") >= LATE_MINUTES
    g = (flights.withColumn("Distance_Category", distance_category())
         .groupBy("Distance_Category")
         .agg(F.count_if(late).alias("#DelayedFlights"), F.count(F.lit(1)).alias("_total")))
    return g.select("Distance_Category", "#DelayedFlights",
                    F.round(C.percent("#DelayedFlights", "_total"), digits).alias("Ratio"))


def cause_by_distance(flights: DataFrame, causes: Sequence[str] = CAUSES, digits: int = 1) -> DataFrame:
    """For every cause and class among delayed flights with that cause > 0: flights, share of
    the cause's flights, mean arrival delay.

    One aggregate by class holds a count and a mean per cause; it is turned
    into rows per cause, and the cause total comes from a window over those
    few aggregated rows.
    """
    late = flights.where(F.col("ArrDelay") >= LATE_MINUTES).withColumn("Distance_Category", distance_category())
    aggs = []
    for c in causes:
        has = F.col(c) > 0
        aggs += [F.count_if(has).alias(f"n_{c}"), F.avg(F.when(has, F.col("ArrDelay"))).alias(f"a_{c}")]
    wide = late.groupBy("Distance_Category").agg(*aggs)
    long = wide.select("Distance_Category", F.explode(F.array(*[
        F.struct(F.lit(c).alias("cause"), F.col(f"n_{c}").alias("NumFlights"), F.col(f"a_{c}").alias("avg"))
        for c in causes])).alias("r")).select("Distance_Category", "r.*").where(F.col("NumFlights") > 0)
    w = Window.partitionBy("cause")
    return long.select("cause", "Distance_Category", "NumFlights",
                       F.round("avg", digits).alias("AvgDelay(min)"),
                       F.round(C.percent(F.col("NumFlights"), F.sum("NumFlights").over(w)), digits).alias("Ratio"))


# ------------------------------------------------------------------ Q5 -----

def flights_by_weekday(flights: DataFrame) -> DataFrame:
    """Flights per day of week."""
    return flights.groupBy("DayOfWeek").count()


def weekend_delay_rate(flights: DataFrame, digits: int = 1) -> DataFrame:
    """% of flights late, weekend against weekday."""
    f = flights.withColumns({"Weekend": C.weekend_label("DayOfWeek"), "Delayed": delayed_flag()})
    return f.groupBy("Weekend").agg(F.round(100 * F.avg("Delayed"), digits).alias("Percentage Delayed"))


NONWEATHER_NAMES = {"CarrierDelay": "Average Carrier Delay (min)", "NASDelay": "Average NAS Delay (min)",
                    "SecurityDelay": "Average Security Delay (min)",
                    "LateAircraftDelay": "Average Late Aircraft Delay (min)"}


def nonweather_weekend_means(flights: DataFrame, digits: int = 2) -> DataFrame:
    """Mean of four causes for late flights without weather delay, weekend against weekday."""
    f = flights.where((F.col("ArrDelay") >= LATE_MINUTES) & (F.col("WeatherDelay") == 0)) \
        .withColumn("Weekend", C.weekend_label("DayOfWeek"))
    return f.groupBy("Weekend").agg(*[F.round(F.avg(c), digits).alias(n) for c, n in NONWEATHER_NAMES.items()])


# ------------------------------------------------------------------ Q6 -----

def delay_recovery(flights: DataFrame, thresholds: Sequence[int] = HAUL_THRESHOLDS,
                   as_is: bool = False) -> DataFrame:
    """Share of flights that left late (DepDelay > 0) and arrived no later than they left,
    by haul class, for several long-haul thresholds.

    Each class is divided by its own total. ``as_is=True`` reproduces the
    reference literally: delays compared as text (T2) and both classes
    divided by the short-haul total (T3). Classes without such flights give
    no row, as a ``groupBy`` on an empty set does. One aggregate for all
    thresholds.
    """
    if as_is:
        recovered = (F.col("DepDelay").cast("double") > 0) & \
            (F.col("ArrDelay").cast("string") <= F.col("DepDelay").cast("string"))
    else:
        recovered = (F.col("DepDelay") > 0) & (F.col("ArrDelay") <= F.col("DepDelay"))
    aggs, parts = [], []
    for t in thresholds:
        for h in ("Long", "Short"):
            in_h = haul_class("Distance", t) == h
            aggs += [F.count_if(in_h & recovered).alias(f"n_{t}_{h}"), F.count_if(in_h).alias(f"t_{t}_{h}")]
    wide = flights.agg(*aggs)
    for t in thresholds:
        for h in ("Long", "Short"):
            den = F.col(f"t_{t}_Short") if as_is else F.col(f"t_{t}_{h}")
            parts.append(F.struct(F.lit(t).alias("threshold"), F.lit(h).alias("Long_Short_Haul"),
                                  F.col(f"n_{t}_{h}").alias("Num"),
                                  C.percent(F.col(f"n_{t}_{h}"), den)
                                  .alias("percentage_of_flights_with_recovered_delays")))
    return wide.select(F.explode(F.array(*parts)).alias("r")).select("r.*").where(F.col("Num") > 0)
