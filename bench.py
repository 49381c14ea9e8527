"""Headline queries, timed: one JSON line with seconds per query (median of the runs after a warm-up)."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from caseloom.registry import QUERIES
from caseloom.session import build_session

HEADLINES = [
    "daily_quantity_per_region", "model_query_fk", "consumption_summary", "group_transform", "top_n_per_group", "snapshot_diff",
    "upsert_result", "row_position", "rolling_mean_group", "event_order", "case_variant", "variant_counts", "clean_text", "tokenize",
    "doc_term_counts", "lemmatize_lookup", "dictionary_replace", "rewrite_lines", "ts_seasonality", "ts_walk_forward",
    "ts_subset_forecast", "additive_forecast", "kmeans_assign",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
