"""Benchmark of the headline plans.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "flagship_segment_means",   # both metrics, all families, 3 segments, mean per run/segment
    "score_table",              # the full per-segment score table
    "accuracy_lev",
    "preservation_lev",
    "consolidate_turns",
    "strip_labels_json",
    "chunk_transcript",
    "sentences_from_text",
    "lines_from_text",
    "model_requests",
    "decode_score_files",
    "run_means",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    from colloquy.session import get_session
    spark = get_session(f"local[{cpus}]", app_name="colloquy-bench", shuffle_partitions=int(cpus))
    from colloquy.plans.catalogue import queries
    qs = queries()
    # steady-state timing: compile every plan's code paths (codegen, JIT,
    # Python workers) on the smallest scale first; not timed
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
