"""Time every registered query on local[$BENCH_CPUS] over $BENCH_SF_DIR
and print one JSON line.

Each query is run to completion with the no-op sink (all rows produced,
nothing collected to the driver), $BENCH_RUNS times (default 3); the
median is reported.  One untimed pass over the smallest data set warms
the JVM first.  Timings are this repository's own; the
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from relkit.catalog import QUERIES          # noqa: E402
from relkit.session import build_session    # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Stage and task times: set BENCH_EVENT_LOG_DIR to a scratch folder and
# read Spark's event log there (the UI stays off).
EVENT_LOG_DIR = os.environ.get("BENCH_EVENT_LOG_DIR")


def run(spark, data_dir: str, q) -> float:
    t0 = time.perf_counter()
    q.run(spark, data_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def forced_split(spark) -> dict[str, float]:
    """The skew-adaptive queries in their split form, which no key of the
    test data calls for; not part of the total."""
    import relkit.operators.analytics as analytics
    import relkit.operators.scan as scan
    rule = scan.split_chunks
    scan.split_chunks = analytics.split_chunks = lambda *a, **k: CPUS
    try:
        names = ("a10_running_total", "a13_spread_median", "a14_rank_within_group",
                 "a16_ntile", "a18_pareto")
        return {q.name: round(run(spark, SF_DIR, q), 3) for q in QUERIES if q.name in names}
    finally:
        scan.split_chunks = analytics.split_chunks = rule


def main() -> None:
    extra = {"spark.driver.memory": "16g"}
    if EVENT_LOG_DIR:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": EVENT_LOG_DIR})
    spark = build_session(f"local[{CPUS}]", app="relkit-bench", shuffle_partitions=CPUS,
                          extra=extra)
    if os.path.isdir(WARM_DIR):
        for q in QUERIES:
            run(spark, WARM_DIR, q)
    times = {q.name: round(statistics.median(run(spark, SF_DIR, q) for _ in range(RUNS)), 3)
             for q in QUERIES}
    forced = forced_split(spark)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "forced_split": forced,
        "sf": float(m.group(1)) if m else None,
        "cpus": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
