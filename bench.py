"""Times the registered queries and prints one JSON line.

Each query is run to its last row without collecting it, after one untimed run of
the flagship query that starts the engine. ``plain_text_copy`` is a bare read and
text write of the rows ``stream_consume`` handles, for comparison; it is not part
of the total.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from shardstream.plans import QUERIES  # noqa: E402
from shardstream.plans.views import table  # noqa: E402
from shardstream.shared import scratch_path  # noqa: E402


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shardstream-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shardstream-bench-"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain_text_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "plain")
    table(spark, sf_dir, "events").select("props").write.text(out)
    return spark.read.text(out)


def seconds(spark: SparkSession, sf_dir: str, query) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds(spark, sf_dir, QUERIES["stream_consume"])
    plain = seconds(spark, sf_dir, plain_text_copy)
    times = {name: seconds(spark, sf_dir, query) for name, query in QUERIES.items()}
    rows = table(spark, sf_dir, "events").count()
    print(
        json.dumps(
            {
                "metric": "all_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "plain_text_copy": plain,
                "stream_consume_rows_per_sec": round(rows / times["stream_consume"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
