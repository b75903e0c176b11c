"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Model jobs are timed only
when named (``python bench.py train_eval``): their time varies with the search.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import QUERIES
from tidemark.session import build_session

HEADLINES = [
    "psi_by_lang", "drift_report", "oov_rate", "vocab_df", "tfidf",
    "stratified_split", "eval_set_hash", "headline_pool", "quarantine_rows", "duplicate_rate",
    "macro_f1", "per_class_report", "threshold_sweep", "delayed_label_accuracy",
    "latency_percentiles", "slo_window", "step_time",
    "rouge_l", "rouge_l_stemmed", "rouge_2", "chat_format",
    "registry_state", "gate_sequence", "lineage_closure", "cascade",
    "stream_dedup", "stream_drift",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
