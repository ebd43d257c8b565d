"""Time the whole flow on rows with hot keys, and how evenly its shuffles are dealt out.

``python bench_skew.py [rows] [partitions]``, 20 million rows on 64 partitions unless given. A third of the rows has
one user, one email and one rid, a tenth has no user; a third of the watch log, half as long, has one user and
one rid. Broadcast joins are off. Prints one JSON line: seconds, rows per second, and the largest task over
the median one by records read, for the stages that read a hundredth of the rows or more.
"""

from __future__ import annotations

import json
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from uidloom.plans.resolution import resolve_valid
from uidloom.sources.session import configure


def stage_reads(events: Path) -> list[list[int]]:
    """Records that each task read from a shuffle, by stage, from Spark's event log."""
    stages: dict[int, list[int]] = {}
    for path in events.rglob("*"):
        if path.is_file():
            for line in path.open(errors="replace"):
                if '"SparkListenerTaskEnd"' in line:
                    event = json.loads(line)
                    read = (event.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    if read:
                        stages.setdefault(event["Stage ID"], []).append(read)
    return list(stages.values())


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    partitions = sys.argv[2] if len(sys.argv) > 2 else "64"
    folder = Path(tempfile.mkdtemp(prefix="skew-"))
    (folder / "events").mkdir()
    builder = (
        configure(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{folder}/events")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    key = F.xxhash64("id") % (n // 10)

    def hot(text: str, value: F.Column = key) -> F.Column:
        return F.when(F.col("id") % 3 == 0, F.lit(f"{text}hot")).otherwise(F.concat(F.lit(text), value.cast("string")))

    rows = spark.range(n).select(
        F.lit("A").alias("metadata_table"), F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 10 != 7, hot("u")).alias("user_id"), hot("e").alias("email"), hot("r", F.col("id")).alias("rid"),
    )
    watched = spark.range(n // 2).select(hot("r", F.col("id")).alias("rid"), hot("u").alias("user_id"))
    masters = spark.range(n // 20).select(F.concat(F.lit("u"), F.col("id")).alias("uuid"), F.concat(F.lit("e"), F.col("id")).alias("username"))
    personas = masters.select(F.col("uuid").alias("id"))
    frames = []
    for name, frame in (("rows", rows), ("masters", masters), ("personas", personas), ("watched", watched)):
        frame.write.parquet(f"{folder}/{name}")
        frames.append(spark.read.parquet(f"{folder}/{name}"))
    start = time.perf_counter()
    resolve_valid(*frames).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    spark.stop()
    large = [r for r in stage_reads(folder / "events") if sum(r) >= n / 100]
    uneven = [max(r) / statistics.median(r) for r in large]
    print(json.dumps({"metric": "skewed_flow", "value": round(seconds, 1), "unit": "sec", "rows": n,
                      "rows_per_sec": round(n / seconds), "largest_over_median": round(max(uneven, default=0), 2)}))


if __name__ == "__main__":
    main()
