"""Times the headline jobs and queries and prints one JSON line.

Jobs run in order and each is timed on its own; what an earlier job wrote is read from disk,
as on a cluster, and its time is not counted again.
"""

import json
import os
import sys
import time

from shoplens.plans.queries import QUERIES
from shoplens.plans.workspace import workspace
from shoplens.session import build_session, pin_utc

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

JOBS = ("events", "interaction_matrix", "item_features", "item_tfidf", "category_complements",
        "content_recommendations", "content_lists", "popular_lists", "control_lists", "item_docs", "user_docs",
        "sessions", "requests", "popular_head", "known_blocks", "trigram_postings", "session_items", "session_features",
        "prepared_requests", "als_lists")
READS = ("bought_together", "embedding_neighbours", "offline_evaluation", "als_unseen_recommendations",
         "als_evaluation", "catalog_indexes", "run_summary", "reranked")


def main():
    spark = pin_utc(build_session("shoplens-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "20g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"}))
    spark.sparkContext.setLogLevel("ERROR")
    ws = workspace(spark, SF_DIR)
    times = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    for name in JOBS:
        timed(f"job_{name}", lambda: ws.table(name))
    for name in READS:
        timed(name, lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "all jobs and headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
