"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (optional) the
queries. Each query runs once to warm up and is then timed; one that takes long is timed the
first time. Its rows go to a sink that reads them all and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

from chatterlens.plans import QUERIES
from chatterlens.session import local_session

HEADLINE = [
    "parse_json_lines", "validate_comment", "expand_slang", "clean_text", "emoji_to_words", "keyword_match",
    "count_window", "requests_x_comments", "keyword_response", "request_resets_counts", "keyword_trend_5min",
    "lexicon_compound", "label_batch", "threshold_sweep", "label_correlation", "subreddit_correlation",
    "frequent_subreddits", "request_heartbeat", "cumulative_positivity", "last_100_points", "replay_schedule",
    "term_stats", "fit_vocabulary", "tfidf_transform", "tfidf_sublinear", "stratified_split", "train_naive_bayes",
    "train_logreg", "train_sgd_incremental", "classification_report", "clean_stream", "label_stream", "keyword_stream",
]


LONG = 15.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, shuffle_partitions=8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
            if seconds[name] > LONG:
                break
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
