"""The study fixtures (FIXTURES.md): row counts, and the nulls, unmatched
lookups and bin edges they are meant to contain."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tessera.sources import bindings as B


def test_row_counts_follow_the_base_tables(spark):
    assert B.delays(spark, SF_ORACLE).count() == 60000
    assert B.crimes(spark, SF_ORACLE).count() == 15000
    assert B.energy(spark, SF_ORACLE).count() == 10000
    assert B.titles(spark, SF_ORACLE).count() == 1000
    assert B.wine(spark, SF_ORACLE).count() == 2000
    assert B.hr(spark, SF_ORACLE).count() == 15000


def test_nulls_and_unmatched_lookups_are_present(spark):
    d = B.delays(spark, SF_ORACLE)
    r = d.agg(F.count_if(F.col("Region").isNull()).alias("r"), F.count_if(F.col("CarrierDelay").isNull()).alias("c"),
              F.count_if(F.col("ArrDelay") >= 15).alias("late")).first()
    assert r["r"] > 0 and r["c"] > 0 and r["late"] > 0
    c = B.crimes(spark, SF_ORACLE).agg(*[F.count_if(F.col(x).isNull()).alias(x)
                                         for x in ("ZIP", "PREMISE TYPE", "OCCURRED TO")]).first()
    assert all(v > 0 for v in c)
    assert B.energy(spark, SF_ORACLE).where(F.col("solar").isNull()).count() > 0
    assert B.energy(spark, SF_ORACLE).where(F.col("wind") == 352).count() > 0     # lowest edge of the wind bins
    w = B.wine(spark, SF_ORACLE)
    assert w.where(F.col("price").isNull()).count() > 0 and w.where(F.col("price").isin(20.0, 50.0, 200.0)).count() > 0


def test_series_positions_are_dense(spark):
    s = B.series(spark, SF_ORACLE)
    g = s.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"),
                                   F.count_distinct("t").alias("d"))
    assert g.count() == 150
    assert g.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0
