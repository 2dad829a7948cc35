"""Hourly power study: calendar parts, weekday and season means, nulls,
income per source, hourly profile, wind classes, largest and smallest source.

Input: ``datetime`` (timestamp) and the measures ``power_demand, nuclear,
gas, solar, hydro, coal, wind, spot_price``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import profile, ratios

# Fixed values of the study.
SOURCES = ("nuclear", "gas", "solar", "hydro", "coal", "wind")
INCOME_NAMES = {"consumption": "power_demand", "nuclear income": "nuclear", "gas income": "gas",
                "solar income": "solar", "hydro income": "hydro", "coal income": "coal",
                "wind income": "wind"}
WIND_EDGES = (352, 6000, 12000, 17769)
WIND_LABELS = ("low", "mid", "high")


def _r(c, digits):
    return F.round(c, digits) if digits is not None else c


def features(energy: DataFrame, ts: str = "datetime") -> list[str]:
    """All columns but the timestamp (T27)."""
    return profile.feature_list(energy, [ts])


def with_calendar(energy: DataFrame, ts: str = "datetime") -> DataFrame:
    """day, month, year, hour, weekday (Monday = 0), weekend flag and season."""
    cal = C.calendar(energy, ts)
    return cal.withColumns({"weekend": C.weekend_flag("weekday"), "season": C.season("month")})


def weekday_means(energy: DataFrame, ts: str = "datetime", digits: int | None = None) -> DataFrame:
    """Mean of every feature by weekday; nulls skipped as pandas does."""
    feats = features(energy, ts)
    return (energy.withColumn("weekday", F.weekday(ts))
            .groupBy("weekday").agg(*[_r(F.avg(c), digits).alias(c) for c in feats]))


def season_summary(energy: DataFrame, ts: str = "datetime", digits: int | None = None) -> DataFrame:
    """Rows, mean demand and mean price per season."""
    return (energy.withColumn("season", C.season(F.month(ts)))
            .groupBy("season").agg(F.count(F.lit(1)).alias("rows"),
                                   _r(F.avg("power_demand"), digits).alias("power_demand"),
                                   _r(F.avg("spot_price"), digits).alias("spot_price")))


def null_report(energy: DataFrame, zero_col: str = "solar") -> DataFrame:
    """Nulls per column and whether ``zero_col`` ever equals 0 (T29), one row."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in energy.columns]
    aggs.append(F.max(F.when(F.col(zero_col) == 0, 1).otherwise(0)).alias(f"{zero_col}_has_zero"))
    return energy.agg(*aggs)


def income(energy: DataFrame, price: str = "spot_price") -> DataFrame:
    """Cost of consumption and income of each source: ``round(sum(q * price))``."""
    return ratios.weighted_totals(energy, INCOME_NAMES, price, digits=0)


def hourly_profile(energy: DataFrame, ts: str = "datetime", digits: int | None = None) -> DataFrame:
    """Mean demand and mean price by hour of day."""
    return (energy.withColumn("hour", F.hour(ts))
            .groupBy("hour").agg(_r(F.avg("power_demand"), digits).alias("power_demand"),
                                 _r(F.avg("spot_price"), digits).alias("spot_price")))


def wind_categories(energy: DataFrame, edges: Sequence[float] = WIND_EDGES,
                    labels: Sequence[str] = WIND_LABELS) -> DataFrame:
    """Right-closed wind classes (T20) with their counts, plus the column's min and max.

    Every label appears, with 0 when empty, as ``value_counts`` of a pandas
    categorical does; values outside the edges (the minimum 352 itself) fall
    in no class.
    """
    spark = energy.sparkSession
    cats = spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)], "wind_category string, _pos int")
    counts = (energy.select(C.cut_right("wind", edges, labels).alias("wind_category"))
              .where(F.col("wind_category").isNotNull())
              .groupBy("wind_category").agg(F.count(F.lit(1)).alias("count")))
    mm = energy.agg(F.min("wind").alias("wind_min"), F.max("wind").alias("wind_max"))
    return (F.broadcast(cats).join(counts, "wind_category", "left")
            .select("wind_category", F.coalesce("count", F.lit(0)).alias("count"))
            .crossJoin(F.broadcast(mm)))


def source_extremes(energy: DataFrame, sources: Sequence[str] = SOURCES, digits: int | None = None) -> DataFrame:
    """The source with the most and the one with the least energy, with totals (T30)."""
    out = ratios.extreme_column(energy, sources)
    if digits is None:
        return out
    return out.withColumns({c: F.round(c, digits) for c in ("highest_total", "lowest_total")})
