"""Wall time of headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from shelfmark.plans import catalogue

HEADLINES = [
    "w2_link_graph", "r1_name_dictionary", "r2_resolve_maker", "r7_contained_name", "r10_match_pages", "r12_match_contained", "k1_field_confidence", "k2_roll_up",
    "k9_derive_technology", "k16_best_value", "q1_classify_queue", "q4_reissues", "q5_cross_maker_names", "q7_freshness", "q10_detector_recall",
    "a1_domain_graph", "a9_spec_summary", "a10_maker_links", "s8_publish",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first query of a session would also be charged for its start
    catalogue.QUERIES["a12_review_list"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        began = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, wall time in all", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
