"""Warm seconds of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose the data and
the cores. Every query is run once to warm up and then timed as the best of ``BENCH_RUNS`` runs;
its whole result is produced (a no-op sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    # query ladder
    "R20_01", "R20_02", "R20_03", "R20_04", "R20_05", "R20_06", "R20_07", "R20_08", "R20_09", "R20_10", "R20_23",
    # named analytics
    "R01", "R02", "R03", "R04", "R05", "R06", "R07", "R08", "R09", "R10", "R11", "R12",
    # enriched join, landing to clean, conversions and the distributed orderings
    "R16", "R17_landing", "P01", "C01", "D02", "A07", "S25", "R19_06",
)


def main() -> None:
    from civiclake.session import get_session
    from workload import load

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known, _ = load()
    chosen = [name for prefix in HEADLINES for name in known if name.startswith(prefix)]

    def once(name: str) -> float:
        began = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in dict.fromkeys(chosen):
        once(name)
        seconds[name] = round(min(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({"metric": "headline queries, warm seconds in total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "lineitem_rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
