"""Wine review study: cleaning, log price, price classes, group
summaries over four dimensions, subsets and frequent groups.

Input: ``country, variety, winery, province, price, points``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C

# Price ladder of the study, tested in this order (T21).
PRICE_RULES = (("cheap", None, 20), ("premium", 15, 50), ("luxury", 50, 200))
PRICE_OTHER = "iconic"
DIMENSIONS = ("country", "variety", "winery", "province")


def clean(wine: DataFrame) -> DataFrame:
    """Drop rows without price or points, add ``one`` and ``ln_price``."""
    return (wine.where(F.col("price").isNotNull() & F.col("points").isNotNull())
            .withColumns({"one": F.lit(1), "ln_price": F.ln("price")}))


def price_category(price: Column | str = "price") -> Column:
    """cheap (<= 20), premium (15, 50], luxury (50, 200], iconic otherwise; first rule wins.

    The premium rule's lower bound 15 is dead because cheap is tested first.
    """
    p = C.col_of(price)
    rules = []
    for name, lo, hi in PRICE_RULES:
        cond = (p <= hi) if lo is None else ((p > lo) & (p <= hi))
        rules.append((cond, name))
    return C.ordered_classes(p, rules, PRICE_OTHER)


def price_category_counts(wine: DataFrame) -> DataFrame:
    """``table(price_category)`` after cleaning."""
    return (clean(wine).withColumn("price_category", price_category())
            .groupBy("price_category").agg(F.count(F.lit(1)).alias("n")))


def group_summaries(wine: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """obs, mean price and mean points by each dimension, in one scan.

    ``groupingSets`` computes all four groupings from one read of the data;
    output ``(dimension, value, obs, average_price, average_points)``.
    """
    w = clean(wine)
    dims = list(dims)
    g = w.groupingSets([[d] for d in dims], *dims).agg(
        F.sum("one").alias("obs"), F.avg("price").alias("average_price"),
        F.avg("points").alias("average_points"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dim_name, value = None, None
    for d in dims:
        is_d = F.col(f"_g_{d}") == 0
        dim_name = F.when(is_d, F.lit(d)) if dim_name is None else dim_name.when(is_d, F.lit(d))
        value = F.when(is_d, F.col(d)) if value is None else value.when(is_d, F.col(d))
    return g.select(dim_name.alias("dimension"), value.alias("value"), "obs", "average_price", "average_points")


def summary_by(wine: DataFrame, dim: str) -> DataFrame:
    """One of the group summaries, for one dimension."""
    return (clean(wine).groupBy(dim)
            .agg(F.sum("one").alias("obs"), F.avg("price").alias("average_price"),
                 F.avg("points").alias("average_points")))


def top_subsets(wine: DataFrame, countries: Sequence[str], varieties: Sequence[str]) -> DataFrame:
    """Rows in the chosen countries, in the chosen varieties, and in both, tagged."""
    w = clean(wine)
    in_c = F.col("country").isin(*countries)
    in_v = F.col("variety").isin(*varieties)
    tags = F.filter(F.array(F.when(in_c, F.lit("countries")), F.when(in_v, F.lit("varieties")),
                            F.when(in_c & in_v, F.lit("countries_varieties"))), lambda x: x.isNotNull())
    return w.select(F.explode(tags).alias("subset"), *wine.columns)


def frequent_groups(wine: DataFrame, dim: str, min_obs: int) -> DataFrame:
    """Groups with more than ``min_obs`` observations, largest first."""
    return (summary_by(wine, dim).where(F.col("obs") > min_obs).select(dim, "obs")
            .orderBy(F.col("obs").desc(), F.col(dim).asc_nulls_last()))
