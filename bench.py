"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Every query is forced to completion through the ``noop`` sink (all rows
computed, nothing shipped to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "h11_psi_lineitem",
    "h1_profile_lineitem",
    "h12_js_lineitem",
    "h18_shift_sensitivity_orders",
    "b1_b12_gate_lineitem",
    "c4_summary_lineitem",
    "c7_iqr_lineitem",
    "d10_preprocess_lineitem",
    "f13_candidates",
    "g8_ensemble_experiment",
    "h9_system_events",
    "h13_data_monitor_lineitem",
    "e1_ecod_lineitem",
    "e1_ecod_new_lineitem",
    "e3_lof_embeddings",
    "e3_lof_new_customers",
    "s1_windows_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from telemetra.jobs import registry
    from telemetra.session import checkpoint_dir, get_spark, release_tables

    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="telemetra-bench")
    checkpoint_dir(spark)      # the cluster's folder, or a scratch one when unset
    queries = registry.queries()
    names = [n for n in HEADLINE if n in queries]
    if len(sys.argv) > 1:
        names = [n for n in names if any(n.startswith(a) for a in sys.argv[1:])]
    # warm-up: JVM, Python workers and parquet footers, not timed
    queries["c3_frequency_lineitem"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        queries[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        release_tables(spark)      # its result is written; not timed
        print(f"{n}: {times[n]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
