import os
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Python workers import the package too; on a cluster --py-files sees to that.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(Path(__file__).parent.parent), *filter(None, [os.environ.get("PYTHONPATH")])]
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        # Not UTC on purpose: no result may depend on the session's zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    """Tables as directories of several files, a third of the events on one key and user."""
    path = str(tmp_path_factory.mktemp("skewed"))

    def number(seed, below):
        return F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(below))

    hot = number(1, 3) == 0
    types = F.array(*map(F.lit, ["signup", "error", "click", "view", "purchase"]))
    hour, month = 3_600_000_000, 710 * 3_600_000_000
    micros = F.when(hot, number(2, hour)).otherwise(number(2, month))
    events = (
        spark.range(0, 60_000, 1, 4)
        .withColumnRenamed("id", "event_id")
        .withColumn("seconds", (micros / 1_000_000).cast("decimal(18, 6)"))
        .select(
            "event_id",
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, seconds)").alias("ts"),
            F.when(hot, 7).otherwise(number(3, 1500)).alias("user_id"),
            F.get(types, number(4, 5)).alias("event_type"),
            (number(5, 10_000) / 100).alias("value"),
            F.concat(F.lit('{"k": '), F.when(hot, 3).otherwise(number(6, 100)), F.lit("}")).alias("props"),
        )
    )
    events.write.parquet(f"{path}/events.parquet")
    spark.read.parquet(f"{sf_dir}/part.parquet").repartition(3).write.parquet(f"{path}/part.parquet")
    return path
