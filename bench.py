"""Time the reports on local cores and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stallbook.registry import QUERIES  # noqa: E402
from stallbook.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONLY = os.environ.get("BENCH_ONLY", "")
# The loads into the catalog are left out: they time the metastore more than a query.
HEADLINE = [name for name in QUERIES if name not in ("s7_failed_loads", "s16_stored_loads")]


def _scale(path: str) -> float | str:
    tail = path.rstrip("/").rsplit("sf", 1)[-1]
    try:
        return float(tail)
    except ValueError:
        return path


def main() -> None:
    spark = build_session(
        "stallbook-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if not ONLY or any(n.startswith(p) for p in ONLY.split(","))]
    # One untimed report starts the JVM's compilers, as a long-running session would have.
    QUERIES["v6_customer_health"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": _scale(SF_DIR)}))


if __name__ == "__main__":
    main()
