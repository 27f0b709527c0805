"""Benchmark: the three reports plus single-operator queries.

Steps (``BENCH_SF_DIR``, default /root/testdata/sf0.1; ``local[BENCH_CPUS]``):

1. derive the workspace from the supplied tables and write it as Parquet
   (timed as ``derive_workspace``);
2. run each report over the written workspace, the production shape (a
   snapshot of eleven tables), with a no-op sink so the whole plan executes
   without collecting anything: one warm-up, then the median of 3 runs;
3. run the single-operator queries on the supplied tables the same way.

Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

OPERATOR_QUERIES = ["win_latest_per_key", "win_first_and_last", "win_rank_ties",
                    "agg_max_json_number", "agg_group_concat_sorted"]


def _sf_label(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def _timed(build) -> float:
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def _median_of(build) -> float:
    _timed(build)                       # warm-up (JIT, file listing caches)
    return statistics.median(_timed(build) for _ in range(RUNS))


def main() -> None:
    from verilens.plans.catalog import queries
    from verilens.plans.reports import report
    from verilens.session import local_session, shared_dir
    from verilens.sources.derived import derive_workspace
    from verilens.sources.workspace import load_workspace, write_workspace

    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2, app="verilens-bench")
    scratch = shared_dir(spark)
    if scratch.startswith("/") or scratch.startswith("file:"):
        scratch = tempfile.mkdtemp(prefix="bench-ws-", dir=scratch.replace("file:", ""))
    else:
        scratch = f"{scratch.rstrip('/')}/bench-ws-{int(time.time())}"

    results: dict[str, float] = {}
    t = time.perf_counter()
    write_workspace(derive_workspace(spark, SF_DIR), scratch)
    results["derive_workspace"] = time.perf_counter() - t

    ws = load_workspace(spark, scratch)
    for name in ("items", "tasks", "conversations"):
        results[name] = _median_of(lambda n=name: report(ws, n))

    qs = queries()
    for key in OPERATOR_QUERIES:
        results[key] = _median_of(lambda k=key: qs[k](spark, SF_DIR))

    timed = {k: round(v, 3) for k, v in results.items()}
    total = round(sum(v for k, v in results.items() if k != "derive_workspace"), 3)
    print(json.dumps({"metric": "reports_and_operators_total", "value": total, "unit": "sec",
                      "queries": timed, "sf": _sf_label(SF_DIR)}))


if __name__ == "__main__":
    main()
