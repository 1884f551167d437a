"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Protocol: one warm-up run per query, then the median of $BENCH_REPEATS runs
(default 5) of a full evaluation into the ``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "attributes_table",
    "rates_gap_fill",
    "rates_gap_fill_window",
    "check_pk",
    "chunk_text",
    "hll_rollup",
    "time_day",
    "check_expression",
    "enum_sort",
    "rate_conversion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "5")))
    names = sys.argv[1:] or HEADLINE

    from ledgerloom.session import build_session
    from ledgerloom.plans.queries import REGISTRY

    try:
        parts = max(8, int(cpus) * 2)
    except ValueError:
        parts = 16
    spark = build_session(cpus=cpus, shuffle_partitions=parts, app_name="ledgerloom-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up
        out[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
