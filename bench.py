"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of
local cores, ``BENCH_RUNS`` how often each query runs (the median counts).
Every query runs over its whole tables and every output row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from anonkit.plans.registry import run  # noqa: E402
from anonkit.session import build_session  # noqa: E402

HEADLINE = [
    "anonymize_orders",
    "export_orders",
    "kanon_4qi",
    "kanon_summary",
    "suppress_small_groups",
    "redact_documents",
    "redact_notes",
    "label_counts",
    "audit_redaction",
    "audit_hash_unique",
    "hash_group_spend",
    "audit_ip_gain",
    "noise_utility_total",
    "postal_distribution",
    "view_customer_behavior",
    "cb04_top5",
    "cb10_best_per_segment",
    "dm06_top_category_country",
    "dm10_rank_lag",
    "ge07_monthly_revenue",
    "ge09_growth_first_last",
    "ge10_city_above_avg",
    "pp01_revenue_category",
    "pp10_running_total",
    "upd_by_key",
    "profile_dataset",
    "gen_orders",
    "sink_full_refresh",
    "src_csv_multiline",
    "stream_anonymize",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "anonkit-bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("pp01_revenue_category", "redact_notes"):
        seconds(name)  # start-up of the JVM, not of the queries
    timed = {name: round(statistics.median(seconds(name) for _ in range(runs)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
