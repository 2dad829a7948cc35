"""Unit tests of the semantic traps on small hand-made frames."""

import math

from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.functions import predicates as P
from tessera.operators import profile, ratios
from tessera.operators import timeseries as TS
from tessera.plans import flights as FL
from tessera.plans import titles as TI
from tessera.plans import wine as WI


def _flights(spark, rows):
    cols = "Origin string, Dest string, Region string, DayOfWeek int, Distance int, ArrDelay int, DepDelay int, " \
           "CarrierDelay int, WeatherDelay int, NASDelay int, SecurityDelay int, LateAircraftDelay int"
    return spark.createDataFrame(rows, cols)


def test_t2_text_compare_differs_from_numbers(spark):
    df = _flights(spark, [("A", "B", "W", 1, 100, 9, 10, None, None, None, None, None),
                          ("A", "B", "W", 1, 100, 20, 3, None, None, None, None, None)])
    num = df.where(F.col("ArrDelay") <= F.col("DepDelay")).count()
    text = df.where(F.col("ArrDelay").cast("string") <= F.col("DepDelay").cast("string")).count()
    assert num == 1 and text == 1
    assert df.where(F.col("ArrDelay").cast("string") <= F.col("DepDelay").cast("string")).first()["ArrDelay"] == 20


def test_t4_region_ratio_ignores_pure_arrival_delay(spark):
    rows = [("A", "B", "W", 1, 100, 30, 0, 0, 0, 0, 0, 0),   # late on arrival only: not counted
            ("A", "B", "W", 1, 100, 30, 5, 0, 0, 0, 0, 0),   # departure delay: counted
            ("A", "B", "W", 1, 100, 0, 0, None, None, None, None, None),
            ("A", "B", None, 1, 100, 0, 5, None, None, None, None, None)]   # null region dropped
    out = FL.region_delay_proportions(_flights(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["Region"] == "W" and r["ratio_DepD"] == round(1 / 3, 3) and r["ratio_ArrD"] == round(1 / 3, 3)


def test_t8_distance_classes(spark):
    df = spark.createDataFrame([(d,) for d in (50, 93, 500, 501, 1100, 1700, 1701, None)], "Distance int")
    got = [r[0] for r in df.select(FL.distance_category()).collect()]
    assert got == ["4.Long", "1.Very Short", "1.Very Short", "2.Short", "2.Short", "3.Medium", "4.Long", "4.Long"]


def test_t10_correlation_of_constant_group_is_null(spark):
    df = spark.createDataFrame([("A", 1, 5), ("A", 2, 5), ("B", 1, 2), ("B", 2, 4), ("B", 3, 7)], "k string, x int, y int")
    out = {r["k"]: r["c"] for r in df.groupBy("k").agg(C.safe_corr("x", "y").alias("c")).collect()}
    assert out["A"] is None and abs(out["B"] - 0.9933992677987828) < 1e-12
    kept = ratios.corr_by(df, "k", {"c": ("x", "y")}).collect()
    assert [r["k"] for r in kept] == ["B"]


def test_t11_not_nan_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert df.where(P.not_nan("x")).count() == 1


def test_t12_half_up_and_half_even(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (-2.25,), (1.005,)], "x double")
    r = df.select(C.round_half_up("x", 1).alias("u"), C.round_half_even("x", 1).alias("e")).collect()
    assert [x["u"] for x in r] == [2.3, 2.4, -2.3, 1.0]
    assert [x["e"] for x in r] == [2.2, 2.4, -2.2, 1.0]
    assert df.select(F.round("x", 2)).collect()[3][0] == 1.01


def test_t13_top_k_ties_broken_by_key(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a", "c", "a", "b", "c"]], "v string")
    out = profile.most_frequent(df, "v", 2).collect()
    assert [r["v"] for r in out] == ["a", "b"]


def test_t15_count_column_vs_rows(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "p string")
    by_col = {r["p"]: r["Total"] for r in profile.group_counts(df, "p", count_col="p").collect()}
    by_row = {r["p"]: r["Total"] for r in profile.group_counts(df, "p").collect()}
    assert by_col[None] == 0 and by_row[None] == 2


def test_t16_share_of_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("OTHER",), (None,)], "p string")
    out = {r["p"]: r["ratio"] for r in ratios.share_by(df, "p", where=F.col("p") != "OTHER", count_col="p").collect()}
    assert out == {"a": 50.0}


def test_t19_weekday_monday_zero(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts")   # a Monday
    r = C.calendar(df, "ts").first()
    assert r["weekday"] == 0 and r["hour"] == 10 and r["month"] == 1


def test_t20_cut_is_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (352.0, 353.0, 6000.0, 6000.5, 17769.0, 17770.0)], "w double")
    got = [r[0] for r in df.select(C.cut_right("w", [352, 6000, 12000, 17769], ["low", "mid", "high"])).collect()]
    assert got == [None, "low", "low", "mid", "high", None]


def test_t21_price_ladder(spark):
    df = spark.createDataFrame([(p,) for p in (10.0, 16.0, 20.0, 21.0, 50.0, 200.0, 201.0)], "price double")
    got = [r[0] for r in df.select(WI.price_category()).collect()]
    assert got == ["cheap", "cheap", "cheap", "premium", "premium", "luxury", "iconic"]


def test_t22_t23_word_counts(spark):
    df = spark.createDataFrame([("  a  b ",), ("",), (None,), ("one two three",), ("w x y z",)], "primaryTitle string")
    got = [r[0] for r in df.select(C.word_count("primaryTitle")).collect()]
    assert got == [2, 0, None, 3, 4]
    t = df.withColumns({"titleType": F.lit("tv"), "runtimeMinutes": F.lit(10.0)})
    assert TI.typed_titles_by_words(t, "tv").count() == 2
    assert TI.typed_titles_by_words(t, "tv", as_is=True).count() == 1


def test_t24_r_style_moments(spark):
    xs = [1.0, 4.0, 9.0, 16.0, 25.0]
    df = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(xs)], "series_id long, t int, value double")
    r = TS.moments(df).first()
    n, m = len(xs), sum(xs) / len(xs)
    s = math.sqrt(sum((x - m) ** 2 for x in xs) / (n - 1))
    skew = sum((x - m) ** 3 for x in xs) / n / s ** 3
    kurt = sum((x - m) ** 4 for x in xs) / n / s ** 4
    assert abs(r["skewness"] - skew) < 1e-12 and abs(r["kurtosis"] - kurt) < 1e-12


def test_t29_any_zero_is_a_flag(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (None,)], "solar double")
    assert profile.any_equal(df, "solar", 0, "z").first()["z"] == 1


def test_t30_extreme_column_names(spark):
    df = spark.createDataFrame([(1.0, 5.0, 3.0), (1.0, 5.0, None)], "a double, b double, c double")
    r = ratios.extreme_column(df, ["a", "b", "c"]).first()
    assert (r["highest_source"], r["lowest_source"]) == ("b", "a")
    tie = spark.createDataFrame([(2.0, 1.0, 2.0)], "c double, b double, a double")
    assert ratios.extreme_column(tie, ["c", "b", "a"]).first()["highest_source"] == "a"


def test_utc_parse_ignores_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:33:02",), ("garbage",), (None,)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [r[0] for r in df.select(C.to_timestamp_utc("s", "yyyy-MM-dd HH:mm:ss")).collect()]
        plain = [r[0] for r in df.select(C.to_timestamp_utc("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert str(got[0]) == "2024-03-10 02:33:02" and got[1:] == [None, None] and plain == got


def test_t1_bad_text_becomes_null_not_error(spark):
    df = spark.createDataFrame([("12",), ("NA",), ("",), ("7.5",)], "d string")
    got = [r[0] for r in C.cast_all(df, ["d"], "int").collect()]
    assert got == [12, None, None, None]


def _haul_rows(spark):
    # (Distance, ArrDelay, DepDelay): two short flights recover, one long flight recovers
    rows = [("A", "B", "W", 1, 500, 5, 10, None, None, None, None, None),
            ("A", "B", "W", 1, 500, 20, 3, None, None, None, None, None),
            ("A", "B", "W", 1, 500, 9, 10, None, None, None, None, None),
            ("A", "B", "W", 1, 500, 0, 0, None, None, None, None, None),
            ("A", "B", "W", 1, 2000, 1, 4, None, None, None, None, None),
            ("A", "B", "W", 1, 2000, 8, 2, None, None, None, None, None)]
    return _flights(spark, rows)


def test_t3_recovery_denominators(spark):
    df = _haul_rows(spark)
    own = {(r["threshold"], r["Long_Short_Haul"]): r for r in FL.delay_recovery(df, [1700]).collect()}
    asis = {(r["threshold"], r["Long_Short_Haul"]): r for r in FL.delay_recovery(df, [1700], as_is=True).collect()}
    assert own[(1700, "Short")]["Num"] == 2 and own[(1700, "Short")]["percentage_of_flights_with_recovered_delays"] == 50.0
    assert own[(1700, "Long")]["percentage_of_flights_with_recovered_delays"] == 50.0
    # as-is: text comparison ('9' <= '10' is false) and division by the short-haul total
    assert asis[(1700, "Short")]["Num"] == 1 and asis[(1700, "Long")]["percentage_of_flights_with_recovered_delays"] == 25.0


def test_t7_security_counts_recorded_values(spark):
    rows = [("A", "B", "W", 1, 100, 20, 5, 0, 0, 0, 0, 0),      # recorded zero: counted
            ("A", "B", "W", 1, 100, 20, 5, 0, 0, 0, 9, 0),
            ("A", "B", "W", 1, 100, 0, 0, None, None, None, None, None),
            ("C", "B", "W", 1, 100, 0, 0, None, None, None, None, None)]
    out = {r["Origin"]: r for r in FL.security_by_airport(_flights(spark, rows)).collect()}
    assert out["A"]["NumFlights"] == 2 and out["A"]["Ratio"] == 50.0 and "C" not in out
    pos = {r["Origin"]: r for r in FL.security_by_airport(_flights(spark, rows), present="positive").collect()}
    assert pos["A"]["NumFlights"] == 1


def test_t9_pair_names_say_what_they_hold(spark):
    rows = [("A", "B", "W", 1, 100, 20, 5, c, 0, n, 0, l) for c, n, l in ((1, 2, 5), (2, 4, 3), (3, 7, 1))]
    r = FL.delay_corr_by_airport(_flights(spark, rows)).first()
    assert set(r.asDict()) == {"Origin", "carrier_nas", "nas_late"}
    assert r["carrier_nas"] == 0.99 and r["nas_late"] == -0.99


def test_t25_quartile_methods(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    exact = {r["stat"]: r["value"] for r in profile.describe(df, ["x"]).collect()}
    ranked = {r["stat"]: r["value"] for r in profile.describe(df, ["x"], method="ranked").collect()}
    approx = {r["stat"]: r["value"] for r in profile.describe(df, ["x"], method="approx").collect()}
    assert exact["25%"] == 1.75 and exact["75%"] == 3.25 and ranked == exact
    assert approx["25%"] == 1.0
