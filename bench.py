"""Wall time of every registered query, one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from postlens.plans.catalog import CATALOG
from postlens.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def run(spark, query) -> float:
    """Seconds to build the query and to produce every row of it."""
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        driver_memory="16g",
        ui_enabled="false",
        ui_showConsoleProgress="false",
        sql_shuffle_partitions=CPUS,
        sql_session_timeZone="UTC",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, CATALOG["hourly_profile"])  # start-up costs belong to no query
    seconds = {name: round(run(spark, query), 3) for name, query in CATALOG.items()}
    line = {
        "metric": "total wall time of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
        "shuffle_partitions": int(CPUS),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
