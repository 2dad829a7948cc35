"""Registered generic operators, SURVEY 2.1-2.4: sources, projection and
casts, filters, joins. Each runs on a whole fixture table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.registry import register
from tessera.functions import columns as C
from tessera.functions import predicates as P
from tessera.operators import joins as J
from tessera.operators import profile
from tessera.plans import flights as FL
from tessera.sources import bindings as B
from tessera.sources.io import read_delimited, read_table, scratch_path, write_text_table

ORDERS_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
ORDERS_NA_SQL = "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END"


def _orders_with_na(spark, sf):
    o = read_table(spark, sf, "orders").select(*ORDERS_COLS)
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")))


# ---------------------------------------------------------------- 2.1 -----

@register("scan_csv_header", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, {ORDERS_NA_SQL} AS o_orderpriority FROM orders""")
def scan_csv_header(spark, sf):
    """All columns read as text; the price is then cast, bad text giving null."""
    path = scratch_path(spark, "orders-csv")
    write_text_table(_orders_with_na(spark, sf), path)
    text = read_delimited(spark, path, ", ".join(f"{c} string" for c in ORDERS_COLS))
    return text.withColumn("o_totalprice", F.col("o_totalprice").try_cast("double"))


@register("scan_csv_infer", f"""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
  o_totalprice, o_orderdate, {ORDERS_NA_SQL} AS o_orderpriority FROM orders""")
def scan_csv_infer(spark, sf):
    """Types inferred from the text: one extra pass over the file."""
    path = scratch_path(spark, "orders-csv")
    write_text_table(_orders_with_na(spark, sf), path)
    return read_delimited(spark, path, infer=True)


@register("scan_csv_semicolon", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_semicolon(spark, sf):
    path = scratch_path(spark, "customer-ssv")
    write_text_table(read_table(spark, sf, "customer"), path, sep=";")
    return read_delimited(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                                       "c_mktsegment string", sep=";")


@register("scan_csv_decimal_comma", "SELECT event_id, value FROM events")
def scan_csv_decimal_comma(spark, sf):
    """``read.csv(sep=';', dec=',')``: decimal commas converted after reading."""
    path = scratch_path(spark, "events-dec")
    e = read_table(spark, sf, "events").select(
        "event_id", F.regexp_replace(F.col("value").cast("string"), r"\.", ",").alias("value"))
    write_text_table(e, path, sep=";")
    return read_delimited(spark, path, "event_id long, value double", sep=";", decimal_comma_columns=("value",))


@register("scan_tsv", "SELECT * FROM titles")
def scan_tsv(spark, sf):
    path = scratch_path(spark, "titles-tsv")
    write_text_table(B.titles(spark, sf), path, sep="\t")
    return read_delimited(spark, path, "titleType string, primaryTitle string, isAdult int, startYear int, "
                                       "runtimeMinutes double", sep="\t", quoted_multiline=True)


@register("scan_csv_quoted", "SELECT doc_id, text, lang, source FROM documents")
def scan_csv_quoted(spark, sf):
    """Quoted free text spanning lines: whole documents round-trip through CSV."""
    path = scratch_path(spark, "documents-csv")
    write_text_table(read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), path)
    return read_delimited(spark, path, "doc_id long, text string, lang string, source string",
                          quoted_multiline=True)


@register("scan_parquet", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_quantity < 10""")
def scan_parquet(spark, sf):
    """Projection and filter reach the Parquet scan (ReadSchema, PushedFilters)."""
    li = read_table(spark, sf, "lineitem")
    return (li.where((F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'"))
                     & (F.col("l_quantity") < 10))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


# ---------------------------------------------------------------- 2.2 -----

@register("project_columns", "SELECT Origin, Dest, Distance, ArrDelay FROM delays")
def project_columns(spark, sf):
    return B.delays(spark, sf).select("Origin", "Dest", "Distance", "ArrDelay")


@register("drop_columns", "SELECT * EXCLUDE (Work_accident, promotion_last_5years, sales) FROM hr")
def drop_columns(spark, sf):
    return B.hr(spark, sf).drop("Work_accident", "promotion_last_5years", "sales")


@register("rename_column", "SELECT * RENAME (sales AS department) FROM hr")
def rename_column(spark, sf):
    return B.hr(spark, sf).withColumnRenamed("sales", "department")


@register("alias_expr", """
SELECT Origin AS "Origin Airport", ArrDelay - DepDelay AS "Arr-Dep (min)", Distance / 50 AS "size.units"
FROM delays""")
def alias_expr(spark, sf):
    d = B.delays(spark, sf)
    return d.select(F.col("Origin").alias("Origin Airport"), (F.col("ArrDelay") - F.col("DepDelay")).alias("Arr-Dep (min)"),
                    (F.col("Distance") / 50).alias("size.units"))


@register("add_constant", "SELECT *, 1 AS one FROM wine")
def add_constant(spark, sf):
    return B.wine(spark, sf).withColumn("one", F.lit(1))


@register("derive_product", "SELECT datetime, nuclear * spot_price AS nuclear_value, "
          "power_demand * spot_price AS consumption_cost FROM energy")
def derive_product(spark, sf):
    e = B.energy(spark, sf)
    return e.select("datetime", (F.col("nuclear") * F.col("spot_price")).alias("nuclear_value"),
                    (F.col("power_demand") * F.col("spot_price")).alias("consumption_cost"))


@register("cast_columns_int", "SELECT datetime, TRY_CAST(hydro AS INTEGER) AS hydro, "
          "TRY_CAST(coal AS INTEGER) AS coal FROM energy")
def cast_columns_int(spark, sf):
    return C.cast_all(B.energy(spark, sf), ["hydro", "coal"], "int").select("datetime", "hydro", "coal")


@register("cast_double", "SELECT Origin, CAST(ArrDelay AS DOUBLE) AS ArrDelay, CAST(Distance AS DOUBLE) AS Distance "
          "FROM delays")
def cast_double(spark, sf):
    return C.cast_all(B.delays(spark, sf), ["ArrDelay", "Distance"], "double").select("Origin", "ArrDelay", "Distance")


@register("cast_float", "SELECT Origin, CAST(DepDelay AS FLOAT) AS DepDelay FROM delays")
def cast_float(spark, sf):
    return C.cast_all(B.delays(spark, sf), ["DepDelay"], "float").select("Origin", "DepDelay")


@register("cast_string", 'SELECT "100 BLOCK ADDR", CAST(ZIP AS VARCHAR) AS ZIP FROM crimes')
def cast_string(spark, sf):
    return B.crimes(spark, sf).select("100 BLOCK ADDR", F.col("ZIP").cast("string").alias("ZIP"))


@register("cast_category", """
SELECT h.id, h.sales, c.sales_code FROM hr h LEFT JOIN
  (SELECT sales, CAST(dense_rank() OVER (ORDER BY sales) - 1 AS INTEGER) AS sales_code
   FROM (SELECT DISTINCT sales FROM hr WHERE sales IS NOT NULL)) c ON h.sales = c.sales""")
def cast_category(spark, sf):
    return C.cast_category(B.hr(spark, sf).select("id", "sales"), "sales")


@register("feature_list", "SELECT * EXCLUDE (datetime) FROM energy")
def feature_list(spark, sf):
    e = B.energy(spark, sf)
    return e.select(*profile.feature_list(e, ["datetime"]))


@register("schema_report")
def schema_report(spark, sf):
    return profile.schema_report(B.hr(spark, sf))


@register("flag_columns", "SELECT Origin, " + ", ".join(
    f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS {c}_present" for c in FL.DELAY_COLUMNS) + " FROM delays")
def flag_columns(spark, sf):
    d = C.flag_present(B.delays(spark, sf), FL.DELAY_COLUMNS)
    return d.select("Origin", *[c + "_present" for c in FL.DELAY_COLUMNS])


@register("ratio_columns", "SELECT Origin, ArrDelay, " + ", ".join(
    f"CAST({c} AS DOUBLE) / CAST(ArrDelay AS DOUBLE) AS proportion_of_{c}" for c in FL.CAUSES)
    + " FROM delays WHERE ArrDelay >= 15")
def ratio_columns(spark, sf):
    d = B.delays(spark, sf).where(F.col("ArrDelay") >= 15)
    return C.ratio_columns(d, FL.CAUSES, "ArrDelay").select(
        "Origin", "ArrDelay", *["proportion_of_" + c for c in FL.CAUSES])


# ---------------------------------------------------------------- 2.3 -----

@register("filter_compare", "SELECT * FROM delays WHERE ArrDelay >= 15")
def filter_compare(spark, sf):
    return B.delays(spark, sf).where(P.compare("ArrDelay", ">=", 15))


@register("filter_any_of", """
SELECT * FROM delays WHERE ArrDelay >= 15 OR DepDelay > 0 OR CarrierDelay > 0 OR WeatherDelay > 0
  OR NASDelay > 0 OR SecurityDelay > 0 OR LateAircraftDelay > 0""")
def filter_any_of(spark, sf):
    thresholds = {"ArrDelay": (">=", 15)} | {c: (">", 0) for c in FL.DELAY_COLUMNS[1:]}
    return B.delays(spark, sf).where(P.any_over(thresholds))


@register("filter_all_of", """
SELECT * FROM crimes WHERE "UCR CRIME CATEGORY" <> '3-MEDIUM' AND "UCR CRIME CATEGORY" <> '4-NOT SPECIFIED'
  AND ZIP IS NOT NULL""")
def filter_all_of(spark, sf):
    c = F.col("UCR CRIME CATEGORY")
    return B.crimes(spark, sf).where(P.all_of(c != "3-MEDIUM", c != "4-NOT SPECIFIED", F.col("ZIP").isNotNull()))


@register("filter_in_list", "SELECT * FROM wine WHERE country IN ('LARGE', 'MEDIUM', 'PROMO', 'SMALL', "
          "'ECONOMY', 'NONE')")
def filter_in_list(spark, sf):
    return B.wine(spark, sf).where(P.in_list("country", ["LARGE", "MEDIUM", "PROMO", "SMALL", "ECONOMY", "NONE"]))


@register("filter_not_null", "SELECT * FROM wine WHERE price IS NOT NULL AND points IS NOT NULL")
def filter_not_null(spark, sf):
    return B.wine(spark, sf).dropna(subset=["price", "points"])


@register("filter_not_nan", "SELECT datetime, solar FROM energy WHERE solar IS NOT NULL AND NOT isnan(solar)")
def filter_not_nan(spark, sf):
    return B.energy(spark, sf).where(P.not_nan("solar")).select("datetime", "solar")


@register("filter_col_vs_col", "SELECT * FROM delays WHERE ArrDelay <= DepDelay")
def filter_col_vs_col(spark, sf):
    return B.delays(spark, sf).where(F.col("ArrDelay") <= F.col("DepDelay"))


@register("filter_after_agg", "SELECT ZIP, count(ZIP) AS TotalCrimes FROM crimes GROUP BY ZIP HAVING count(ZIP) >= 5")
def filter_after_agg(spark, sf):
    return profile.group_counts(B.crimes(spark, sf), "ZIP", "TotalCrimes", count_col="ZIP") \
        .where(F.col("TotalCrimes") >= 5)


@register("filter_range_zoom", "SELECT price FROM wine WHERE price BETWEEN 0 AND 100")
def filter_range_zoom(spark, sf):
    return B.wine(spark, sf).where(P.between("price", 0, 100)).select("price")


@register("conditional_replace", """
SELECT id, CASE WHEN sales IN ('support', 'IT') THEN 'technical' ELSE sales END AS department FROM hr""")
def conditional_replace(spark, sf):
    return B.hr(spark, sf).select("id", C.replace_values("sales", ["support", "IT"], "technical").alias("department"))


# ---------------------------------------------------------------- 2.4 -----

@register("join_left_broadcast_using", """
SELECT c_custkey, c.n_nationkey, n_name, n_regionkey
FROM (SELECT c_custkey, c_nationkey AS n_nationkey FROM customer) c LEFT JOIN nation n ON c.n_nationkey = n.n_nationkey""")
def join_left_broadcast_using(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return J.lookup_join(c, read_table(spark, sf, "nation"), "n_nationkey", "left")


@register("join_left_broadcast_expr", """
SELECT c_custkey, c_nationkey, n_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def join_left_broadcast_expr(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    return J.lookup_join(c, n, F.col("c_nationkey") == F.col("n_nationkey"), "left")


@register("join_chain_enrich", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') r ON n_regionkey = r_regionkey""")
def join_chain_enrich(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf, "region").where(F.col("r_name") != B.EXCLUDED_REGION)
    x = J.lookup_join(c, n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    x = J.lookup_join(x, r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return x.select("c_custkey", "n_name", "r_name")


@register("join_inner_aggregates", """
SELECT t.Region, Total_flights, late_flights FROM
  (SELECT Region, count(*) AS Total_flights FROM delays GROUP BY Region) t JOIN
  (SELECT Region, count(*) AS late_flights FROM delays WHERE ArrDelay >= 15 GROUP BY Region) l
  ON t.Region = l.Region""")
def join_inner_aggregates(spark, sf):
    d = B.delays(spark, sf)
    t = d.groupBy("Region").agg(F.count(F.lit(1)).alias("Total_flights"))
    late = d.where(F.col("ArrDelay") >= 15).groupBy("Region").agg(F.count(F.lit(1)).alias("late_flights"))
    return J.join_aggregates(t, late, "Region")


@register("join_scalar_total", """
SELECT Origin, count(*) AS NumFlights, count(*) / (SELECT count(*) FROM delays) * 100 AS pct_of_all
FROM delays GROUP BY Origin""")
def join_scalar_total(spark, sf):
    d = B.delays(spark, sf)
    g = d.groupBy("Origin").agg(F.count(F.lit(1)).alias("NumFlights"))
    total = d.agg(F.count(F.lit(1)).alias("_total"))
    return J.with_scalar(g, total).select("Origin", "NumFlights", C.percent("NumFlights", "_total").alias("pct_of_all"))

