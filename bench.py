"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table directory, ``BENCH_CPUS`` the number of local cores.
Every query is timed once, with its
whole result computed by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tongues.plans import queries as Q

HEADLINE = (
    "page_links",
    "page_sentences",
    "collect_sentences",
    "clean_sentences",
    "distinct_sentences",
    "capped_corpus",
    "augment_counts",
    "balance",
    "stratified_split",
    "feat_vector",
    "char_ngrams",
    "vocabulary",
    "tfidf",
    "class_report",
    "train_model",
    "detect_batch",
    "suite_eval",
    "stream_new_sentences",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tongues-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.time()
        Q.QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    run("read_pages")  # start the JVM's code paths and the Python workers
    times = {}
    for name in HEADLINE:
        times[name] = run(name)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    turns = Q.turns(spark, directory).count()
    training = Q.trained(spark, directory)  # fitted by train_model above, which the later model queries reuse
    accuracy = training.accuracy().first()["accuracy"]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
                "held_out_accuracy": round(accuracy, 4),
                "model": {"trees": Q.MODEL.trees, "max_depth": Q.MODEL.max_depth, "folds": Q.MODEL.folds, "reused_by": ["detect_batch", "suite_eval"]},
                "detect_ms_per_text": round(1000 * times["detect_batch"] / max(turns, 1), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
