"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_QUERIES, a comma list, other
queries; BENCH_RUNS the timed runs, of which the median counts, after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postgauge.queries import QUERIES  # noqa: E402
from postgauge.session import local_session  # noqa: E402

HEADLINE = [
    "read_posts_xml",
    "strip_html",
    "quality_label",
    "median_label",
    "match_questions_answers",
    "qa_counts",
    "iqr_filter",
    "length_histogram",
    "qf_flesch",
    "qf_action_density",
    "quality_features",
    "clean_text_ascii",
    "tokenize_sentences",
    "text_report",
    "mean_word_vector",
    "svd_reduce",
    "impute_median",
    "standard_scale",
    "one_hot_topk",
    "structured_features",
    "split_by_group",
    "apply_labels",
    "expand_labels",
    "classification_report",
    "knn_graph",
    "project_2d",
    "train_logistic",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
                "driver_memory": spark.conf.get("spark.driver.memory", "default"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
