"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ONLY (comma-separated query names). Each query is materialised in full through the
no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from eventmart.plans.queries import QUERIES
from eventmart.session import build_session

HEADLINE = (
    "dedup_events",
    "silver_push",
    "silver_pr",
    "dq_audit",
    "top_repos",
    "contributors",
    "merge_insert_only",
    "merge_upsert",
    "dim_date",
    "attach_keys",
    "fact_push",
    "fact_pr",
    "repo_activity",
    "language_yearly",
    "vw_ai_boom",
    "vw_covid_impact",
    "vw_repo_health",
    "vw_pr_lifecycle",
    "vw_bus_factor",
    "vw_ecosystem_growth",
    "vw_hourly_heatmap",
    "vw_abandonment_by_language",
    "vw_contributor_dynamics",
    "features_all",
    "abandonment_labels",
    "trajectory_pivot",
    "language_trend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths once, outside the timings
    QUERIES["dim_contributor"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
