"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: sample folder (default /root/testdata/sf0.1); BENCH_CPUS: cores.

`from_files.*` start at the raw Parquet files. `warehouse.*` read the star
schema that `build_star` wrote before, which is how the marts, the dashboard
cards and the lookup workloads are meant to be read. Each query runs once to
warm up and is then timed; build_star is timed cold and warm.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lumenmart.plans.loader import MARTS, materialise  # noqa: E402
from lumenmart.plans.registry import QUERIES  # noqa: E402
from lumenmart.plans.star import Star  # noqa: E402
from lumenmart.session import local_session, shared_dir  # noqa: E402

FROM_FILES = (
    "fct_events",
    "fct_daily_user_activity",
    "fct_sessions",
    "sessionize_30min",
    "scd2_asof",
    "dim_professors_fuzzy",
    "latency_percentiles",
    "event_contract",
    "incremental_append",
    "orders_trailing_customers",
)
WAREHOUSE = (
    *MARTS,
    "workload_a",
    "workload_b",
    "workload_c",
    "north_star_weekly",
    "retention_first_activity",
    "cohort_week_matrix",
    "session_percentiles",
    "funnel_conversion",
    "navigation_flow",
    "power_users",
    "institution_topn",
    "engagement_corr",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, "bench")
    seconds: dict[str, float] = {}
    for name in FROM_FILES:
        run(QUERIES[name](Star.of_sample(spark, sf_dir)))
        seconds[f"from_files.{name}"] = timed(lambda n=name: run(QUERIES[n](Star.of_sample(spark, sf_dir))))
    star = None
    for label in ("build_star_cold", "build_star"):
        start = time.perf_counter()
        star = materialise(Star.of_sample(spark, sf_dir), shared_dir(spark, "bench"))
        seconds[label] = round(time.perf_counter() - start, 3)
    for name in WAREHOUSE:
        run(QUERIES[name](star))
        seconds[f"warehouse.{name}"] = timed(lambda n=name: run(QUERIES[n](star)))
    timed_queries = {k: v for k, v in seconds.items() if k != "build_star_cold"}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed_queries.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
