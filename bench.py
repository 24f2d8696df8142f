"""Time the headline queries; prints one JSON line.

Every query starts from the raw tables and runs into a no-op sink, so all rows
and columns are computed and none travel to Python. The supplied tables are one file
with one row group each, hence one map task; a local shuffle read would keep the
join and the sort behind it on that task, so it is off here. Streaming and stored-layer
queries start from landed Parquet files, written before the clock starts.
"""

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES, landed, landed_by_year
from delayworks.scratch import set_scratch

HEADLINE = (
    "silver_transform",
    "gold_daily_route",
    "gold_monthly_carrier",
    "gold_route_performance",
    "partitioned_roundtrip",
    "gold_batch_daily_route",
    "bronze_stream",
    "silver_stream",
    "silver_stream_clean",
    "silver_stream_stored",
    "gold_stream_append",
    "gold_stream_append_partitioned",
    "gold_stream_arrival",
    "gold_stream_changes",
    "gold_stream_event_time",
)
RUNS = 3


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    set_scratch(spark, tempfile.mkdtemp(prefix="bench-"))
    for kind in ("flights", "ordered", "unique"):
        landed(spark, sf_dir, kind)
    landed_by_year(spark, sf_dir, "unique")
    runs = {name: [timed(spark, sf_dir, name) for _ in range(RUNS)] for name in HEADLINE}
    seconds = {name: round(statistics.median(times), 3) for name, times in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, median run of each, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "runs": RUNS,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
