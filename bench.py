"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from kotomori.plans.catalogue import QUERIES
from kotomori.session import local_session

HEADLINE = (
    "high_risk_rate",
    "clean_text",
    "clean_corpus",
    "normalise_evasion",
    "prepare_raw_first",
    "doc_freq",
    "vocab_topk",
    "idf",
    "transform_features",
    "l2_normalise",
    "stratified_split",
    "class_report",
    "assign_taxonomy",
    "tier_policy",
    "review_queue",
    "sink_predictions_json",
    "stream_evasion",
    "lemmatise",
)


def run(spark, sf: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), os.environ.get("BENCH_MEMORY", "7g"), "bench")
    spark.sparkContext.setLogLevel("OFF")
    run(spark, sf, "preview")  # start the executors before the clock
    seconds = {name: round(run(spark, sf, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
