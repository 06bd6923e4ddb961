"""Time every registered query on the tables in $BENCH_SF_DIR; print one JSON line.

Each query is built and run to completion into a no-op sink, twice: the first run includes code
generation and file listing (``cold``), the second is the figure reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from meterline.plans.queries import registered
from meterline.session import get_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = get_session(
        "meterline-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, query in registered().items():
        if only and name not in only:
            continue
        for seconds in (cold, warm):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
