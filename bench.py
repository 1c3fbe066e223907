"""Time the named analyses; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated name prefixes (default: all named analyses)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from encore.session import session
from workload import QUERIES, run

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONLY = tuple(p for p in os.environ.get("BENCH_ONLY", "q1,q2,q3,q4,q5,q6,q7,q8,q9").split(",") if p)


def consume(df) -> int:
    """Produce every row and column without bringing them to the driver; number of scans planned."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan")


def shuffled_bytes(spark) -> int:
    """Bytes written to shuffles so far, over all stages."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main() -> None:
    written = tempfile.TemporaryDirectory(prefix="encore-bench-")
    spark = session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.ui.retainedStages": "100000",
        "spark.checkpoint.dir": written.name,
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if n.startswith(ONLY) and not n.endswith("_marts")]
    consume(run("q3_top_artists", spark, FOLDER))  # start-up and compilation are not measured
    seconds, shuffled, scans = {}, {}, {}
    for name in names:
        before = shuffled_bytes(spark)
        start = time.perf_counter()
        scans[name] = consume(run(name, spark, FOLDER))
        seconds[name] = round(time.perf_counter() - start, 3)
        shuffled[name] = shuffled_bytes(spark) - before
    spark.stop()
    written.cleanup()
    print(json.dumps({
        "metric": "named analyses, total wall clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffle_bytes": shuffled,
        "scans": scans,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
