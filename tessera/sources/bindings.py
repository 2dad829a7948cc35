"""Bindings: the study schemas derived from the test tables (FIXTURES.md).

The reference reads seven CSV inputs that are not shipped. Each function here
derives a table of the same shape from the Parquet test data, with nulls,
unmatched lookup keys and values on bin edges made on purpose, so that every
study query runs over whole tables that grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.operators.sorting import position_within, running_sum_within
from tessera.sources.io import read_table

# Fixed values of the bindings (FIXTURES.md).
EXCLUDED_REGION = "ASIA"          # its nations get a null Region (unmatched lookup)
ARR_MODULUS = 120                 # ArrDelay = ship-order day gap mod 120
SERIES_DRIFT = 49.6               # centre of the random-walk series


# fact tables whose scans are spread over all cores when the files give few splits
FACT_TABLES = ("lineitem", "orders", "events", "documents")


def _t(spark: SparkSession, sf_dir: str, name: str, spread: bool | None = None) -> DataFrame:
    return read_table(spark, sf_dir, name, spread=(name in FACT_TABLES) if spread is None else spread)


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights: ``Origin, Dest, Region, DayOfWeek, Distance, ArrDelay, DepDelay`` and five causes.

    The tables that grow with the flights (part, orders and their customers)
    are joined by sort and merge at any size, so shuffled bytes follow the
    rows: lineitem is dealt twice, by part and by order, and carries keys and
    nation numbers instead of names. Suppliers are broadcast behind a size
    check. Nation and region have 25 and 5 rows by the TPC-H definition; they
    come last, and their broadcast is left to the planner's size estimate
    (``broadcast='auto'``), which costs no extra job.
    """
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = (_t(spark, sf_dir, "region").where(F.col("r_name") != EXCLUDED_REGION)
              .select("r_regionkey", "r_name"))
    origin = lookup_join(nation, region, F.col("n_regionkey") == F.col("r_regionkey"), broadcast="auto") \
        .select(F.col("n_nationkey").alias("_origin"), F.col("n_name").alias("Origin"), F.col("r_name").alias("Region"))
    dest = nation.select(F.col("n_nationkey").alias("_dest"), F.col("n_name").alias("Dest"))
    # lineitem and orders are dealt by their keys in the joins: spreading them would only add a shuffle
    li = _t(spark, sf_dir, "lineitem", spread=False).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    orders = _t(spark, sf_dir, "orders", spread=False).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ordered = lookup_join(orders, customer, F.col("o_custkey") == F.col("c_custkey"), how="inner", broadcast="never")
    x = lookup_join(li, supplier, F.col("l_suppkey") == F.col("s_suppkey"), how="inner")
    x = lookup_join(x, part, F.col("l_partkey") == F.col("p_partkey"), how="inner", broadcast="never")
    x = lookup_join(x, ordered, F.col("l_orderkey") == F.col("o_orderkey"), how="inner", broadcast="never")
    x = lookup_join(x, dest, F.col("s_nationkey") == F.col("_dest"), how="inner", broadcast="auto")
    x = lookup_join(x, origin, F.col("c_nationkey") == F.col("_origin"), how="inner", broadcast="auto")
    arr = f"CAST(datediff(l_shipdate, o_orderdate) % {ARR_MODULUS} AS INT)"
    late = f"{arr} >= 15"
    qty = "CAST(l_quantity AS INT)"
    # one projection written as SQL text (one call to the JVM instead of one per operator)
    return x.selectExpr(
        "Origin", "Dest", "Region",
        "CAST(weekday(l_shipdate) + 1 AS INT) AS DayOfWeek",
        "CAST(p_size * 50 AS INT) AS Distance",
        f"{arr} AS ArrDelay",
        f"CAST({arr} + l_linenumber * 10 - 50 AS INT) AS DepDelay",
        f"CASE WHEN {late} THEN greatest(CAST(round(l_discount * 100) AS INT) - 5, 0) * 6 END AS CarrierDelay",
        f"CASE WHEN {late} THEN greatest(CAST(round(l_tax * 100) AS INT) - 4, 0) * 8 END AS NASDelay",
        f"CASE WHEN {late} THEN CASE WHEN l_linenumber = 7 THEN {qty} ELSE 0 END END AS SecurityDelay",
        f"CASE WHEN {late} THEN greatest({qty} - 25, 0) END AS LateAircraftDelay",
        f"CASE WHEN {late} THEN CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey % 40 AS INT) ELSE 0 END END "
        "AS WeatherDelay",
    )


def crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crimes: ``OCCURRED ON/TO, UCR CRIME CATEGORY, PREMISE TYPE, 100 BLOCK ADDR, ZIP``."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    x = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return x.select(
        F.col("o_orderdate").alias("OCCURRED ON"),
        F.when(F.col("o_orderkey") % 20 != 0, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
        .alias("OCCURRED TO"),
        F.col("o_orderpriority").alias("UCR CRIME CATEGORY"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("OTHER"))
        .otherwise(F.col("c_mktsegment")).alias("PREMISE TYPE"),
        F.col("c_name").alias("100 BLOCK ADDR"),
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("ZIP"),
    )


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly power: ``datetime`` and eight measures; ``solar`` has nulls, ``wind`` hits the lowest edge."""
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    return e.select(
        F.timestamp_add("DAY", eid % 360, F.col("ts")).alias("datetime"),
        (F.col("value") * 50).alias("power_demand"),
        (F.col("value") * 12).alias("nuclear"),
        ((F.col("user_id") + 1) * 10).cast("double").alias("gas"),
        F.when(F.col("event_type") != "view", F.col("value") * 3).alias("solar"),
        (eid % 97).cast("double").alias("hydro"),
        ((eid % 53) * 2).cast("double").alias("coal"),
        F.when(eid % 100 == 0, F.lit(352.0)).otherwise(F.col("value") * 36).alias("wind"),
        ((eid % 71).cast("double") + 0.5).alias("spot_price"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles: ``titleType, primaryTitle, isAdult, startYear, runtimeMinutes``."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    b = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("b_doc_id"), "toxic")
    x = d.join(b, F.col("doc_id") == F.col("b_doc_id"), "left")
    return x.select(
        F.col("source").alias("titleType"),
        F.when(F.col("doc_id") % 31 != 0, F.col("text")).alias("primaryTitle"),
        F.coalesce(F.col("toxic"), F.lit(0)).cast("int").alias("isAdult"),
        F.lit(2019).alias("startYear"),
        F.when(F.col("doc_id") % 9 != 0, F.col("n_chars").cast("double") / 50).alias("runtimeMinutes"),
    )


def wine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wine reviews: ``country, variety, winery, province, price, points``."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.col("p_partkey")
    return p.select(
        F.when(k % 41 != 0, F.col("p_type")).alias("country"),
        F.col("p_name").alias("variety"),
        F.col("p_brand").alias("winery"),
        F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 5).cast("string")).alias("province"),
        F.when(k % 11 != 0, ((k * 37) % 400 + 1).cast("double")).alias("price"),
        F.when(k % 13 != 0, (80 + F.col("p_size") % 21).cast("int")).alias("points"),
    )


# Department code by customer key modulo 10 (FIXTURES.md, hr).
HR_DEPARTMENTS = ("sales", "technical", "support", "IT", "hr", "RandD", "marketing",
                  "accounting", "product_mng", "management")


def hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee turnover: ``id``, seven numeric features, ``sales``, ``salary``, label ``left``."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    dept = None
    for i, name in enumerate(HR_DEPARTMENTS):
        cond = (c % 10) == i
        dept = F.when(cond, F.lit(name)) if dept is None else dept.when(cond, F.lit(name))
    return o.select(
        k.alias("id"),
        (((k * 37) % 92 + 9).cast("double") / 100).alias("satisfaction_level"),
        (((k * 53) % 65 + 36).cast("double") / 100).alias("last_evaluation"),
        (2 + k % 6).cast("int").alias("number_project"),
        (96 + (k * 71) % 215).cast("int").alias("average_montly_hours"),
        (2 + F.when(c % 40 == 0, F.lit(8)).otherwise(c % 3)).cast("int").alias("time_spend_company"),
        F.when(c % 7 == 0, 1).otherwise(0).alias("Work_accident"),
        F.when(c % 47 == 0, 1).otherwise(0).alias("promotion_last_5years"),
        dept.alias("sales"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "high")
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "medium")
        .otherwise("low").alias("salary"),
        F.when(((k * 37) % 92 < 36) & ((k % 6 == 0) | (F.col("o_totalprice") > 250000)), 1)
        .otherwise(0).alias("left"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many time series in long form ``(series_id, t, value)``, t = 1..n per series.

    Positions follow ``(ts, event_id)`` within a user; they are numbered
    without a per-user window, so one very active user is spread over tasks.
    """
    e = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("series_id"), "ts", "event_id", "value")
    return position_within(e, ["series_id"], ["ts", "event_id"], name="t").select("series_id", "t", "value")


def series_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-stationary companion: running sum of ``value - 49.6`` within each series."""
    return walk_of(series(spark, sf_dir))


def walk_of(s: DataFrame) -> DataFrame:
    """Running sum of ``value - 49.6`` within each series of ``s``."""
    w = running_sum_within(s, ["series_id"], ["t"], F.col("value") - SERIES_DRIFT, name="walk")
    return w.select("series_id", "t", F.col("walk").alias("value"))


def hr_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed predictions for checking metrics by SQL (FIXTURES.md, inputs for metrics)."""
    h = hr(spark, sf_dir)
    return h.select("id", F.col("left").alias("label"),
                    F.when(F.col("satisfaction_level") < 0.45, 1).otherwise(0).alias("prediction"))


# Severity classes for the crimes binding, whose categories are
# order priorities (FIXTURES.md, crimes).
CRIME_SEVERITY = {"1-URGENT": "4.EXTREME", "2-HIGH": "3.MAJOR", "3-MEDIUM": "2.INTERMEDIATE"}
