"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tallyloom import catalog
from tallyloom.session import local_session

HEADLINE = (
    "flagship_chart", "report_pipeline", "control_limits", "shift_rebaseline", "series_gap_fill",
    "measure_improved", "episode_build", "day_collapse", "preferred_score", "discharge_split",
    "snapshot_latest_member", "snapshot_active_30d", "snapshot_valid_span", "eligibility_flag",
    "classify_claim_lines", "unmatched_claims", "merge_sources_priority", "rate_site_network",
    "measure_event_count", "measure_after_first", "upsert_chain", "cell_extract", "agg_list3",
    "join_star", "join_or", "join_effective_dim", "join_theta_left", "join_point_in_interval",
    "join_null_safe", "keep_latest_ties", "keep_first_ordered", "agg_count_distinct", "sort_multi",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.registry.QUERIES)
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])  # class loading and code generation of the first job
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
