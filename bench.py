"""Run the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidewright.plans import registry

HEADLINE = ["q05_orphans", "q06_last_wins", "q07_primary_pick", "q08_priority_pivot", "q09_merge_upsert", "q12_changed_rows", "q16_freshness", "q18_idle_runs", "q23_numeric_parse", "q30_sha_dedupe", "q33_window_sma"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, took = registry.queries(), {}
    for name in HEADLINE:
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        began = time.time()
        found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, second run", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
