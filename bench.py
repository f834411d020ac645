"""Time every registered query and print one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_QUERIES
(comma-separated names, default all). Each query runs to its last row; the time
includes planning and any stage table the query writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pathgauge.session import session
from pathgauge.sources.stages import remove_stages
from testbed.queries import QUERIES


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the engine before the clock does: class loading is not a query.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:20} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    record = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "spark": spark.version,
        "master": f"local[{cpus}]",
        "shuffle_partitions": int(cpus),
    }
    remove_stages(spark)
    spark.stop()
    print(json.dumps(record))
    return 0


if __name__ == "__main__":
    sys.exit(main())
