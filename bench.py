"""Time the headline queries: one JSON line, seconds per query (median of the runs)."""

from __future__ import annotations

import json
import os
import statistics
import time

from siltstone.queries import QUERIES
from siltstone.session import local_session

HEADLINE = (
    "q_latest_event",
    "q_first_per_state",
    "q_latest_with_ties",
    "q_first_seen",
    "q_exact_dedup_newest",
    "q_dedup_documents",
    "q_surrogate_id",
    "q_lookup",
    "q_join_detail",
    "q_channel_sums",
    "q_id_diff_labelled",
    "q_snapshot_merge",
    "q_props",
    "q_clean_text",
    "q_flatten",
    "q_envelope",
    "q_multi_format_ts",
    "q_profile",
    "q_timeline",
    "q_student_flag",
    "q_account_360",
    "q_risk_report",
    "q_score_table",
    "q_wealth_income",
    "q_funnel_report",
    "q_curated_events",
    "q_raw_transactions",
    "q_positions_summary",
    "q_compaction",
    "q_stream_arrivals",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session("bench", cores, os.environ.get("BENCH_MEMORY", "12g"))
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run:  # the first run warms up
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
