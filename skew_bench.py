"""Time the analyses on generated purchases with one very busy player and one very popular item.

``SKEW_ROWS`` purchases of ``SKEW_PLAYERS`` players; a third of the rows each go to player 0 and to item
0, independently. Prints a line per query: seconds, and from Spark's event log the largest stage's
tasks with the rows they read. The tables and the log go to a new folder below ``SKEW_FOLDER``.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playmetrics.plans import frequency, funnel, purchases
from playmetrics.sources.tables import from_parquet

ANALYSES = (
    funnel.race_funnel, purchases.activity_by_payer, purchases.item_popularity,
    frequency.frequency_segments, frequency.purchase_gaps, funnel.race_purchasers,
)


def write_tables(spark: SparkSession, folder: str, rows: int, players: int) -> None:
    pick = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    third = lambda seed: pick(seed, 3) == 0
    events = spark.range(rows).select(
        F.col("id").alias("transaction_id"),
        F.when(third("p"), 0).otherwise(pick("player", players)).alias("player"),
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(secs=pick("time", 365 * 86400).cast("decimal(18,6)"))).alias("date"),
        (pick("amount", 5000) / 100).cast("decimal(18,2)").alias("amount"),
        F.when(third("i"), 0).otherwise(pick("item", 5000)).alias("item_code"),
    ).withColumnRenamed("player", "id")
    users = spark.range(players).select(
        "id", pick("payer", 2).cast("int").alias("payer"), pick("race", 20).cast("int").alias("race_id")
    )
    race = spark.range(20).select(
        F.col("id").cast("int").alias("race_id"), F.concat(F.lit("race "), "id").alias("race")
    )
    items = spark.range(5000).select(
        F.col("id").alias("item_code"), F.concat(F.lit("item "), "id").alias("game_items")
    )
    for name, df in (("events", events), ("users", users), ("race", race), ("items", items)):
        df.write.parquet(f"{folder}/{name}")


def task_ends(log: Path) -> list[tuple[int, int, int]]:
    """(stage, rows read from shuffles, milliseconds) of every task in the event log."""
    found = []
    for file in log.rglob("*"):
        if file.is_file() and not file.name.startswith("."):
            for line in file.open(errors="replace"):
                if '"SparkListenerTaskEnd"' in line:
                    e = json.loads(line)
                    m = e.get("Task Metrics") or {}
                    rows = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    found.append((e["Stage ID"], rows, m.get("Executor Run Time", 0)))
    return found


def main() -> None:
    rows = int(os.environ.get("SKEW_ROWS", "40000000"))
    players = int(os.environ.get("SKEW_PLAYERS", "1000000"))
    folder = tempfile.mkdtemp(prefix="skew-", dir=os.environ.get("SKEW_FOLDER"))
    log = Path(folder, "log")
    log.mkdir()
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("playmetrics-skew")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{folder}/stored")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{log}")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    write_tables(spark, folder, rows, players)
    seen = 0
    repeated = [(frequency.frequency_segments, False), (funnel.race_funnel, False)]
    for analysis, unique in [*((a, True) for a in ANALYSES), *repeated]:
        game = from_parquet(spark, folder, unique_transactions=unique)
        start = time.perf_counter()
        analysis(game).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        time.sleep(2)  # for the event log
        ends = task_ends(log)
        stages = defaultdict(list)
        for stage, read, ms in ends[seen:]:
            stages[stage].append((read, ms))
        seen = len(ends)
        largest = max(stages.values(), key=lambda tasks: sum(read for read, _ in tasks))
        print(json.dumps({
            "query": analysis.__name__ + ("" if unique else ", ids may repeat"),
            "seconds": round(seconds, 1),
            "rows_shuffled": sum(read for read, _ in largest),
            "tasks": len(largest),
            "most_rows": max(read for read, _ in largest),
            "median_ms": statistics.median(ms for _, ms in largest),
            "slowest_ms": max(ms for _, ms in largest),
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
