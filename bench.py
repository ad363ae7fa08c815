"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS].

Each query is fully executed into Spark's no-op sink (no collect to the driver) and timed; prints one JSON line.
Before timing, the first query runs once on the smallest scale (JVM start-up and code generation are not counted).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "token_counts", "thread_tag_weights", "pos_frequency", "corpus_summary", "strip_html", "clean_text",
    "clean_data", "prepare_posts", "bag_of_words", "tfidf", "tags_in_post", "doc_mean_vector", "similar_by_word",
    "auto_tag", "evaluate_autotag", "naive_bayes", "classification_metrics", "nb_gridsearch", "knn_classify",
    "topic_relevance", "topic_distance", "cap_per_thread", "csv_export_import",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    from tagloom.plans.catalog import QUERIES
    from tagloom.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        QUERIES[only[0]](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else None, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
