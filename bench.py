"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names, optional).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from storyspark.plans.queries import QUERIES
from storyspark.session import STATIC

HEADLINE = ["title_clusters", "ingest_job", "duplicate_signatures", "recent_repeats", "base_scores",
            "edition_picks", "mix_picks", "pool_identities", "clean_sentence_sets", "drafts",
            "quota_decisions", "region_memberships", "story_metadata", "speaker_turns"]


def session(cpus: str) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
               .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g"))
    for key, value in STATIC.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    # The derived story table is an input of every job: it is timed on its own.
    started = time.perf_counter()
    from storyspark.plans import inputs
    inputs.candidates(spark, sf)
    seconds = {"derive_candidates": round(time.perf_counter() - started, 3)}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
