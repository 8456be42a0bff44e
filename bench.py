"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR  folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the median counts (default 3)
BENCH_ONLY    comma-separated query names
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)

HEADLINE = [
    "flagship",
    "feature_battery",
    "ewm_mean",
    "streak",
    "rolling_min_max",
    "dense_spine",
    "dedupe_keep_first",
    "join_orientation",
    "enrich_chain",
    "feature_join_back",
    "calendar_fill",
    "calendar_anti",
    "target_encode",
    "rank_in_group",
    "position_in_group",
    "sequence_next",
    "label_encode",
    "median_impute",
    "time_folds",
    "evaluate",
    "permutation_importance",
    "report_sorted",
    "preprocess_fit_score",
    "gbt_fit_score",
    "sequence_score",
    "model_roundtrip",
    "systematic_panel",
    "individual_panel",
]


def main() -> None:
    from panelweave.lineage import clear_scratch, scratch
    from panelweave.session import build_session
    from queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", cpus, **{"spark__driver__memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        with scratch(spark):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    times = {}
    for name in names:
        run(name)  # warm-up: class loading, code generation, file listing
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, median per query, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
