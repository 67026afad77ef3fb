"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the cores of the local session. Each
query runs to its end (every row is produced and dropped) after one unmeasured warm-up
query that starts the session and its code paths.
"""

from __future__ import annotations

import json
import os
import time

from panelwright.session import local_session, remove_run
from workload import QUERIES

HEADLINE = [
    "q_audit",
    "q_rule_waterfall",
    "q_missingness",
    "q_recode",
    "q_prepare",
    "q_duplicate_audit",
    "q_duplicate_examples",
    "q_describe_all",
    "q_describe_sketch",
    "q_group_median",
    "q_period_trend",
    "q_correlation",
    "q_pivot",
    "q_lookup_join",
    "q_hash_sample",
    "q_codelist_extract",
    "q_roundtrip",
    "q_silhouette",
    "q_choose_k",
    "q_cross_tab",
    "q_error_by_band",
    "q_error_by_model",
    "q_select_config",
    "q_linear_grid",
    "q_forest_grid",
    "q_refit_test",
    "q_kmeans_grid",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("q_raw_frequency")
    seconds = {name: run(name) for name in HEADLINE}
    remove_run(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
