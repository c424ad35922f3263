"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores. Every query is run to a full result (noop sink), after one warm-up of
the session on the smallest of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapwise.queries import QUERIES  # noqa: E402
from lapwise.session import build_session  # noqa: E402

# Groups follow the published task times: silver, gold, integration, training, checks and reports.
HEADLINE = (
    # silver
    "dedup_keep_latest", "stop_summary", "race_master_join", "lap_delta_to_leader", "weather_features", "parse_clock",
    # gold
    "race_features", "rolling_form", "constructor_form", "circuit_history", "streaks_before", "ewm_form", "ewm_event_value",
    "championship", "rating_simultaneous",
    # integration
    "lap_features", "tire_degradation", "tire_features", "prior_season_standing", "stints_and_tyre_age", "complete_features",
    # checks, discovery, reports
    "health_report", "feature_hypotheses", "regression_metrics", "rank_metrics", "latest_race_summary",
    "driver_season_stats", "ask_top_five_by_rating",
    # sources and streams
    "scan_drifting_schemas", "flatten_results_pages", "stream_landing_to_bronze",
    # training
    "cross_validated_error", "feature_importances", "compare_position_models", "searched_settings",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").count().write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))


if __name__ == "__main__":
    main()
