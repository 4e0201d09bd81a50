"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Each query
is run once to warm up at the smallest scale found next to the folder, then timed to
a sink that reads every row and column.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "clean_text", "tfidf_weights", "retrieve_topk", "pair_features", "drift_report",
    "pii_redact",
)
OTHERS = (
    "text_features", "stratified_split", "split_leaks", "ngrams", "chunks", "token_ids",
    "recall_at_k", "dense_topk", "pair_features_indexed", "pair_grid", "request_validate",
    "score_requests", "binary_metrics", "drift_by_window", "safety_gate", "run_gates",
    "dataset_fingerprint", "registry_report", "pii_roundtrip", "judge_pairs",
    "judge_parse", "group_softmax", "attention_pool",
)
RUNS = 3


def session(cpus: str):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tandem-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tandem-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(fn, spark, folder) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from tandem.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    small = str(Path(folder).parent / "sf0.001")
    warm = small if Path(small).is_dir() else folder
    names = sys.argv[1:] or [*HEADLINE, *OTHERS]
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, warm)
        runs = [timed(QUERIES[name], spark, folder)]
        while name in HEADLINE and len(runs) < RUNS:
            runs.append(timed(QUERIES[name], spark, folder))
        seconds[name] = round(statistics.median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = Path(folder).name.removeprefix("sf")
    print(
        json.dumps(
            {"metric": "query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
