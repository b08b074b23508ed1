"""Benchmark at $BENCH_SF_DIR on local[$BENCH_CPUS]: build the warehouse, then serve reports.

One run = (1) build every model of the analog ledger from the raw test tables, in
build order, timing each model (``build:<model>``; models that are plain projections
stay lazy and cost nothing here, their work lands in their readers), then (2) run
every headline catalogue query over the built warehouse. Each query is executed in
full through Spark's ``noop`` sink (no collect). The value is the sum of all
timings; each timing is the median of ``$BENCH_REPEATS`` runs, every run starting
from an empty warehouse. A few warm-up queries precede them. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_level", "yearly_level", "yearly_budgeted", "unpivot_ordered", "conditional_sums",
    "conditional_columns", "split_expand", "enrich_chain", "dense_rollup", "date_range",
    "pay_monthly", "audit_forall", "grain_check", "row_ids", "json_flatten", "json_two_level",
    "typed_from_text", "latest_per_key", "chart_monthly_overview", "chart_yearly_spending",
    "overview_labels_monthly", "serve_year_slice", "ordered_serving", "yearly_group",
    "group_slice_needs", "sanitize_nonfinite",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from abacus.catalogue import QUERIES, Ledger
    from abacus.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="abacus-bench",
                        extra={"spark.driver.memory": "16g"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="abacus-bench-"))
    names = only or HEADLINE

    def one_run() -> dict[str, float]:
        Ledger._open.clear()
        ledger = Ledger.of(spark, sf)
        times = {}
        for model in Ledger.build_order():
            t0 = time.perf_counter()
            ledger[model]
            times[f"build:{model}"] = time.perf_counter() - t0
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = time.perf_counter() - t0
        return times

    # warm-up (JVM start, JIT, file listing): the queries that touch every input table
    for name in ("scan_project", "row_ids", "typed_from_text", "split_expand", "json_flatten"):
        Ledger._open.clear()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    runs = [one_run() for _ in range(repeats)]
    med = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    build = round(sum(v for k, v in med.items() if k.startswith("build:")), 3)
    print(json.dumps({
        "metric": "warehouse_build_plus_report_queries_seconds",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "build_seconds": build,
        "queries": med,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
