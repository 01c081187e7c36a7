"""Times headline queries, each forced whole with a no-op sink; the median of
BENCH_RUNS runs after a first. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "activity_by_year", "dedupe_first", "scd2_build", "asof_fact", "rating_distribution", "country_participation", "organization_suppressed", "tag_landscape",
    "twin_map", "response_matrix", "temporal_split", "census_report", "distinct_surrogate", "data_checks", "compare_full_outer", "roundtrip_partitioned",
)


def main() -> None:
    from tallyspan.session import build_session

    spark = build_session("bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS), driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    from tallyspan.plans.catalogue import QUERIES

    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        took[name] = round(statistics.median(times[1:]), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
