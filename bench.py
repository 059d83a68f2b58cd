"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Each query is run in full (every row and column is produced, none is kept)
after one warm-up run.
"""

from __future__ import annotations

import json
import os
import time

from vacancylake.plans.queries import registered
from vacancylake.session import build_session

HEADLINE = [
    "jobs_overview", "filtered_overview", "search_postings", "latest_postings", "recent_postings", "overview_stats",
    "platform_stats", "summary_stats", "top_companies", "remote_share", "daily_counts", "recent_activity",
    "salary_histogram", "salary_kde", "salary_box", "id_ranges", "key_check", "table_counts",
    "local_date", "salary_range_parse", "section_split", "page_fields", "page_links",
    "extract_listings", "extract_details", "ingest_listings",
    "upsert_first_wins", "upsert_mixed", "quality_report", "atomic_accept", "cascade_delete", "listing_detail_join",
    "dedup_first", "source_quota", "activity_windows", "daily_windows", "adhoc_sql",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench", cpus, spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = registered()
    seconds = {}
    for name in HEADLINE:
        query, _ = entries[name]
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(runs[-1], 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
