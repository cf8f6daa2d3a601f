"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "fct_matches", "match_cards", "group_standings", "head_to_head_standings", "groups_qualified",
    "reconcile_standings", "dim_teams", "key_metrics", "goals_by_stage", "scorelines", "latest_results",
    "edition_comparison", "top_scorers_mart", "latest_snapshot", "outcome_probabilities", "team_strength",
    "upsets", "team_paths", "poisson_fit", "advancement", "chronological_pairs", "check_results",
    "check_unique_combination", "run_summary", "freshness",
]


def main() -> int:
    from scoreloom.catalog import QUERIES
    from scoreloom.config import session

    spark = session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[HEADLINE[0]](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # warm-up with a real scan
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.monotonic()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
