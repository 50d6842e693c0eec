"""Time the operators on skewed clicks and show how evenly their tasks shared the work.

    python scale_check.py 40000000 /folder/for/data

A third of the clicks fall on one product in one hour. Task times come from Spark's event
log, written next to the data.
"""

import json
import statistics
import sys
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions import hour_bucket
from clickmill.operators import (
    activity_by_product,
    apply_updates,
    drop_duplicate_events,
    estimate_visitors,
    last_write_per_key,
    merge,
    missing_rows,
    not_in,
    rollup_by_product,
    visitor_sketches,
    visitors_by_product,
)
from clickmill.schema import ACTIVITY
from clickmill.session import configure

MONTH_MS = 30 * 24 * 3_600_000
START_MS = 1_704_067_200_000


def skewed_clicks(spark: SparkSession, rows: int) -> DataFrame:
    def number(seed: int, below: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(below))

    hot = number(1, 3) == 0
    action = number(4, 20)
    return (
        spark.range(0, rows, 1, 64)
        .select(
            (F.lit(START_MS) + F.when(hot, number(2, 3_600_000)).otherwise(number(2, MONTH_MS)))
            .alias("eventtime"),
            F.lit("Google").alias("referrer"),
            F.when(action == 0, "purchase").when(action < 3, "add_to_cart").otherwise("page_view")
            .alias("action"),
            F.lit("").alias("prevpage"),
            F.concat(F.lit("Visitor-"), number(5, 1_000_000)).alias("visitor"),
            F.concat(F.lit("Page-"), number(6, 16)).alias("page"),
            F.concat(F.lit("Brand,Product "), F.when(hot, 0).otherwise(1 + number(3, 20_000)))
            .alias("product"),
        )
        .withColumn("timestamp_hour", hour_bucket("eventtime"))
        .select(ACTIVITY.names)
    )


def operators(activity: DataFrame, batch: DataFrame, speed: DataFrame) -> dict[str, DataFrame]:
    return {
        "activity_by_product": activity_by_product(activity),
        "visitors_by_product": visitors_by_product(activity),
        "rollup_by_product": rollup_by_product(activity),
        "visitor_sketches": estimate_visitors(visitor_sketches(activity)),
        "last_write_per_key": last_write_per_key(activity, ["eventtime", "visitor"]),
        "drop_duplicate_events": drop_duplicate_events(activity, ["eventtime", "visitor"]),
        "merge": merge(batch, speed),
        "merge ordered": merge(batch, speed, ordered=True),
        "apply_updates": apply_updates(batch, speed),
        "missing_rows": missing_rows(batch, speed),
        "not_in": not_in(speed, batch),
    }


def report(log: Path) -> None:
    """One line per stage: tasks, median and longest task, shuffled bytes, spilled bytes."""
    stage_of, tasks = {}, defaultdict(list)
    with log.open() as lines:
        for line in lines:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    stage_of.setdefault(stage, event["Properties"].get("spark.job.description"))
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                info, metrics = event["Task Info"], event["Task Metrics"]
                tasks[event["Stage ID"]].append((
                    info["Finish Time"] - info["Launch Time"],
                    metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"],
                    metrics["Disk Bytes Spilled"],
                ))
    for stage, found in sorted(tasks.items()):
        millis, shuffled, spilled = zip(*found, strict=True)
        print(
            f"{stage_of.get(stage)} stage {stage}: {len(found)} tasks, "
            f"median {statistics.median(millis):.0f} ms, longest {max(millis)} ms, "
            f"shuffled {sum(shuffled) / 1e6:.0f} MB, spilled {sum(spilled) / 1e6:.0f} MB"
        )


def main() -> None:
    rows, folder = int(sys.argv[1]), Path(sys.argv[2])
    logs = folder / "event-log"
    logs.mkdir(parents=True)
    one_machine = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "64",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logs.as_uri(),
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
    }
    spark = configure(SparkSession.builder.master("local[8]"), one_machine).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    skewed_clicks(spark, rows).write.parquet(f"{folder}/activity")
    activity = spark.read.parquet(f"{folder}/activity")
    middle = START_MS + MONTH_MS // 2
    for name, side in (("batch", F.col("eventtime") < middle), ("speed", F.col("eventtime") > middle)):
        # Visitors decide the side in the hours both tables share.
        half = activity.where(side | (F.col("visitor") < "Visitor-5"))
        activity_by_product(half).write.parquet(f"{folder}/{name}")
    batch, speed = (spark.read.parquet(f"{folder}/{name}") for name in ("batch", "speed"))
    for name, frame in operators(activity, batch, speed).items():
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
    spark.stop()
    report(next(logs.iterdir()))


if __name__ == "__main__":
    main()
