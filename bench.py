"""Headline timings: every build step of the study, then analyst queries on its tables.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. The build steps are timed once more on a tenth of the
data (``BENCH_SMALL_DIR``, left out if it is not there): ``build_small`` tells what a step costs whatever its rows; it is not in the total.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumeworks.plans.queries import QUERIES  # noqa: E402
from plumeworks.plans.tables import tables  # noqa: E402
from plumeworks.session import build_session  # noqa: E402

BUILDS = ["hourly", "weather", "values", "daily", "monthly", "weather_daily", "coords", "pairing", "combined", "registry"]
HEADLINE = [
    "S2_partitioned_scan", "W1_rolling_8h", "A13_ozone_8hr_4th_max", "A14_design_values", "A15_daily_stats",
    "A17_weather_daily", "J4_nearest_station", "R1_site_pairing", "R2_combined_daily", "R3_site_registry",
    "K1_partition_overwrite", "K4_append_delta", "Q1_exceeding_sites", "Q3_county_years", "Q6_summer_and_winter",
    "Q12_weather_correlations", "Q14_parameter_profile", "Q19_diurnal_profile", "Q22_regression_rows",
    "Q23_eight_hour_peaks", "Q25_manuscript_table", "Q26_pollution_rose", "Q29_non_null_rates", "Q30_descriptives",
    "Q39_partition_counts", "Q40_pruned_scan",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before timing
    timings = {}

    def timed(name, action):
        start = time.time()
        action()
        timings[name] = round(time.time() - start, 3)
        print(f"{name:32s} {timings[name]:8.3f}", file=sys.stderr)

    def run(name):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    built = tables(spark, folder)
    timed("step_dedup", lambda: run("P1_exact_dedup"))
    for name in BUILDS:
        timed(f"build_{name}", lambda: built.get(name))
    timed("step_validate", lambda: run("V8_report"))
    for name in HEADLINE:
        timed(name, lambda: run(name))
    small = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
    total, found = round(sum(timings.values()), 3), dict(timings)
    if os.path.isdir(small) and os.path.realpath(small) != os.path.realpath(folder):
        built = tables(spark, small)
        for name in BUILDS:
            timed(f"small_{name}", lambda: built.get(name))
    print(json.dumps({
        "metric": "total seconds for all build steps and headline queries",
        "value": total,
        "unit": "sec",
        "queries": found,
        "build_small": {k.removeprefix("small_"): v for k, v in timings.items() if k.startswith("small_")},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
