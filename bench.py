"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from feedloom.plans.queries import all_queries
from feedloom.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "url_normalize", "title_normalize", "html_clean", "feed_date_parse", "feed_parse", "score_breakdown",
    "score_breakdown_custom", "growth_stage", "either_key_dedupe", "either_key_dedupe_by_date", "ranked_articles",
    "must_read_top3", "cited_items", "digest_document", "source_health_final", "source_health_history",
    "outage_runs", "feed_cache_upsert", "cached_articles", "archive_fallback", "run_status", "prior_digest_asof",
    "stream_health", "stream_daily_counts",
)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        # The first run compiles the plan's code; the second one counts.
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
