"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes, nothing is collected) and is timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.catalog.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = (
    "q_region_delay_proportions", "q_security_by_origin", "q_delay_cooccurrence", "q_delay_corr_by_airport",
    "q_distance_summary", "q_cause_by_distance", "q_weekend_delay_rate", "q_delay_recovery",
    "q_profile_columns", "q_extreme_categories", "q_zip_severity", "q_zip_severity_pivot",
    "q_energy_weekday_means", "q_energy_income", "q_energy_wind_category", "q_title_types",
    "q_short_long_titles", "q_wine_group_summaries", "q_wine_frequent_groups", "q_hr_profile",
    "box_stats", "kde_1d", "hist_all_numeric", "ts_moments", "ts_ljung_box", "ts_shapiro",
    "fe_skewed_features", "fe_feature_importance", "ml_classification_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)),
                          app_name="tessera-bench")
    reg = load_all()
    # warm the JVM and the Python workers on the smallest data, untimed
    reg["q_region_delay_proportions"].fn(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for key in HEADLINE:
        t0 = time.perf_counter()
        reg[key].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
