"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs whole, into Spark's no-op sink: one warm-up run, then the median of BENCH_RUNS
timed runs. Building the plan counts as part of a run.
"""

import json
import os
import statistics
import sys
import time

from workload.queries import QUERIES
from workload.session import local_session

HEADLINES = [
    "entry",
    "raw_mail",
    "rfc2822_time",
    "html_to_text",
    "response_time",
    "response_time_events",
    "missing_ids",
    "clean_documents",
    "language",
    "spam_flag",
    "ensure_parents",
    "dedupe",
    "addresses",
    "entities_regex",
    "entities_json",
    "invoke_model",
    "categories",
    "summaries",
    "embed",
    "svd",
    "l2_normalise",
    "density_cut",
    "topics",
    "topic_samples",
    "word_frequencies",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, seconds[name], [round(t, 2) for t in taken], file=sys.stderr)
    scale = sf_dir.rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
