"""Crime profiling study: column profiles, ratios by category and
severity, top premises, severe-crime share by ZIP and its pivot.

Input columns: ``OCCURRED ON, OCCURRED TO`` (timestamps), ``UCR CRIME
CATEGORY, PREMISE TYPE, 100 BLOCK ADDR`` (text), ``ZIP``. Names are resolved
case-insensitively, as Spark does by default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import profile, ratios

# The study's severity classes.
SEVERITY_MAP = {
    "ARSON": "3.MAJOR",
    "AGGRAVATED ASSAULT": "3.MAJOR",
    "RAPE": "4.EXTREME",
    "MURDER AND NON-NEGLIGENT MANSLAUGHTER": "4.EXTREME",
    "LARCENY-THEFT": "2.INTERMEDIATE",
    "ROBBERY": "3.MAJOR",
    "MOTOR VEHICLE THEFT": "2.INTERMEDIATE",
}
SEVERITY_DEFAULT = "1.MINOR"
SEVERE_CLASSES = ("3.MAJOR", "4.EXTREME")
CATEGORY = "UCR CRIME CATEGORY"
PREMISE = "PREMISE TYPE"
SEVERITY = "CRIME SEVERITY"


def with_severity(crimes: DataFrame, mapping: Mapping[str, str] = SEVERITY_MAP,
                  default: str = SEVERITY_DEFAULT) -> DataFrame:
    return crimes.withColumn(SEVERITY, C.map_values(CATEGORY, mapping, default))


def profile_columns(crimes: DataFrame, ks: Mapping[str, int]) -> DataFrame:
    """Nulls, distinct values, k least and most frequent values per column."""
    return profile.profile_columns(crimes, ks)


def earliest_rows(crimes: DataFrame, ts: str = "OCCURRED ON", n: int = 10) -> DataFrame:
    """First ``n`` rows by time; the other columns break ties."""
    others = [c for c in crimes.columns if c != ts]
    order = [F.col(f"`{ts}`").asc_nulls_last()] + [F.col(f"`{c}`").asc_nulls_last() for c in others]
    return crimes.orderBy(*order).limit(n)


def extreme_categories(crimes: DataFrame, cols: Sequence[str] = (CATEGORY, PREMISE)) -> DataFrame:
    """Least and most frequent crime category and premise with counts, one row."""
    return profile.extremes(crimes, cols)


def category_ratio(crimes: DataFrame, key: str = CATEGORY, digits: int = 1) -> DataFrame:
    """Crimes per class and their % of all crimes."""
    return ratios.share_by(crimes, key, count_col=key, denominator="all", name="NUM CRIMES",
                           pct_name="ROUNDED RATIO", digits=digits)


def severity_ratio(crimes: DataFrame, mapping: Mapping[str, str] = SEVERITY_MAP,
                   default: str = SEVERITY_DEFAULT, digits: int = 1) -> DataFrame:
    """Crimes per severity class and their % of all crimes."""
    return category_ratio(with_severity(crimes, mapping, default), SEVERITY, digits)


def top_premises(crimes: DataFrame, k: int = 20, exclude: str = "OTHER", digits: int = 1) -> DataFrame:
    """Top ``k`` premise types by crimes, without ``exclude``, % of all crimes.

    ``!= exclude`` also drops the null premise (T14), as in the reference.
    """
    shares = ratios.share_by(crimes, PREMISE, where=F.col(f"`{PREMISE}`") != exclude, count_col=PREMISE,
                             denominator="all", name="NUM CRIMES/PREMISE", pct_name="RATIO", digits=digits)
    return shares.orderBy(F.col("`NUM CRIMES/PREMISE`").desc(), F.col(f"`{PREMISE}`").asc_nulls_last()).limit(k)


def premise_totals(crimes: DataFrame) -> DataFrame:
    """Non-null premise count per premise; the null premise counts 0 (T15)."""
    return profile.group_counts(crimes, "Premise Type", name="TotalPremise", count_col="Premise Type")


def zip_severity(crimes: DataFrame, mapping: Mapping[str, str] = SEVERITY_MAP,
                 default: str = SEVERITY_DEFAULT, min_total: int = 5, digits: int = 2) -> DataFrame:
    """Severe crimes per ZIP and class, with % of the ZIP's crimes, for ZIPs with at least
    ``min_total`` crimes. Unordered; see ``top_zip_severity``."""
    sev = with_severity(crimes, mapping, default)
    cond = F.col(f"`{SEVERITY}`").isin(*SEVERE_CLASSES)
    out = ratios.share_of_group(sev, ["ZIP"], SEVERITY, where=cond, name="NUM CRIME SEVERITY",
                                total_name="TotalCrimes", pct_name="SEVERITY BY ZIP RATIO",
                                count_col=SEVERITY, total_count_col="ZIP", digits=digits)
    return out.where(F.col("TotalCrimes") >= min_total)


def top_zip_severity(crimes: DataFrame, k: int = 100, **kw) -> DataFrame:
    """``zip_severity`` ordered by count and ZIP, both descending, first ``k``."""
    return zip_severity(crimes, **kw).orderBy(
        F.col("`NUM CRIME SEVERITY`").desc(), F.col("ZIP").desc(), F.col(f"`{SEVERITY}`").asc()).limit(k)


def zip_severity_pivot(crimes: DataFrame, k: int = 40, **kw) -> DataFrame:
    """One row per ZIP, one ratio column per severe class, top ``k`` by extreme then major."""
    piv = ratios.pivot_value(zip_severity(crimes, **kw), "ZIP", SEVERITY, list(SEVERE_CLASSES),
                             "SEVERITY BY ZIP RATIO", "min")
    return piv.orderBy(F.col("`4.EXTREME`").desc_nulls_last(), F.col("`3.MAJOR`").desc_nulls_last(),
                       F.col("ZIP").asc()).limit(k)
