"""Seconds per headline query: a warm-up and one measured run each; prints one JSON line.

Queries that BENCH_SECONDS does not reach are named under "missed".
"""

from __future__ import annotations

import json
import os
import threading
import time

from pyspark.sql import SparkSession

from tidewright.queries import QUERIES

HEADLINE = (
    "final_score", "value_score", "risk_score", "bus_factor_hhi", "top_share_tie_inclusive", "class_by_share", "repo_eco_class", "pnorm_mass",
    "risk_percentile", "group_collapse_multi", "two_level_sum", "count_distinct_window", "asof_backward_year", "all_years_division",
    "merge_urls_priority", "url_classify", "yank_verdict", "latest_per_key", "quality_rules", "pagerank_k", "dep_closure", "identity_components",
)


def main() -> None:
    where = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.master": f"local[{cpus}]", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true",
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    started, limit = time.time(), float(os.environ.get("BENCH_SECONDS", "240"))
    for name in HEADLINE:
        left = limit - (time.time() - started)
        if left <= 0:
            break
        alarm = threading.Timer(left, spark.sparkContext.cancelAllJobs)
        alarm.start()
        try:
            for _ in range(2):
                began = time.time()
                QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
                took = time.time() - began
            seconds[name] = round(took, 3)
        except Exception:
            if time.time() - started < limit:  # not the alarm
                raise
        finally:
            alarm.cancel()
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "missed": [n for n in HEADLINE if n not in seconds], "sf": os.path.basename(where.rstrip("/"))}))


if __name__ == "__main__":
    main()
