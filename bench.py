"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores.
Every query writes its whole result to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from quillframe.operators.partitions import spread
from quillframe.plans.topics import (
    TopicSettings,
    annotate,
    count_vector_stage,
    documents_with_topic,
    fit_topics,
)
from quillframe.queries import QUERIES
from quillframe.session import local_session

HEADLINE = [
    "scan_csv",
    "scan_text",
    "group_avg",
    "conditional_counts",
    "join_inner",
    "subtract_rows",
    "regex_grep_count",
    "vector_top_k",
    "text_stages",
    "stem_vocab",
    "vocabulary",
    "count_vectors",
    "topic_hits",
    "topic_words",
    "staged_topic_run",
    "word_vectors",
    "synonyms",
    "glm_gaussian",
    "logit_binomial",
    "gbt_regress",
    "naive_bayes",
    "kmeans",
    "als",
]


def topics_100_iterations(spark, folder):
    """The longest published setting: a topic fit of 100 iterations on all documents."""
    settings = TopicSettings(iterations=100)
    documents = spread(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    stage = count_vector_stage(annotate(documents, "text").select("doc_id", "tokens"), settings, "doc_id")
    return documents_with_topic(fit_topics(stage, settings).distribution(stage.vectors))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("bench", cpus, os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and the Python workers' code paths on the smallest table.
    QUERIES["partition_udf"](spark, folder).limit(1).write.format("noop").mode("overwrite").save()
    seconds = {}
    runs = {name: QUERIES[name] for name in HEADLINE} | {"topics_100_iterations": topics_100_iterations}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
