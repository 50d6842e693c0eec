"""Whole and right results where a third of all rows share one key."""

import pytest
from pyspark.sql import functions as F

from clickmill.operators import (
    drop_duplicate_events,
    last_write_per_key,
    latest_hours,
    merge,
    not_in,
    rollup_by_product,
)
from clickmill.schema import KEYS

N = 300_000
HOT = N // 3


@pytest.fixture(scope="module")
def activity(spark):
    """Every third click on one product in one hour, by 1,000 visitors; 500 other products."""
    hot = F.col("id") % 3 == 0
    number = F.floor(F.col("id") / 3)
    rows = spark.range(0, N, 1, 16).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product"),
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 24 * 3_600_000).cast("bigint").alias("timestamp_hour"),
        F.when(hot & (number % 10 == 0), "purchase").otherwise("page_view").alias("action"),
        F.concat(F.lit("v"), number % 1000).alias("visitor"),
        F.col("id").alias("eventtime"),
    )
    return rows.cache()


def hot_row(frame):
    return frame.where("product = 'hot'").first().asDict()


def test_rollup(activity):
    assert hot_row(rollup_by_product(activity)) == {
        "product": "hot", "timestamp_hour": 0, "purchase_count": HOT // 10, "add_to_cart_count": 0,
        "page_view_count": HOT - HOT // 10, "unique_visitors": 1000,
    }
    total = rollup_by_product(activity).agg(F.sum(F.expr("purchase_count + page_view_count")))
    assert total.first()[0] == N


def test_last_write(activity):
    kept = last_write_per_key(activity, ["eventtime"])
    assert hot_row(kept)["eventtime"] == N - 3
    assert kept.count() == activity.select(*KEYS).distinct().count()


def test_latest_hours_of_a_product_with_a_third_of_the_keys(spark):
    table = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("product"),
        (F.col("id") * 3_600_000).alias("timestamp_hour"),
    )
    kept = latest_hours(table, 3)
    assert kept.where("product = 'hot'").agg(F.min("timestamp_hour")).first()[0] == 8991 * 3_600_000
    assert kept.count() == 6003


def test_copies_of_one_event(activity):
    copies = activity.withColumn("offset", F.when(F.col("product") == "hot", 0).otherwise(F.col("eventtime")))
    assert drop_duplicate_events(copies, ["offset"]).count() == N - HOT + 1


def test_merge(activity):
    early = activity.where(F.col("eventtime") < N // 2)
    late = activity.where(F.col("eventtime") >= N // 2)
    sides = [rollup_by_product(side) for side in (early, late)]
    merged = merge(*sides)
    assert hot_row(merged)["purchase_count"] == HOT // 10
    assert merged.count() == rollup_by_product(activity).count()


def test_not_in_with_a_product_in_a_third_of_the_keys(spark):
    keys = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("product"),
        (F.col("id") * 3_600_000).alias("timestamp_hour"),
    )
    listed = keys.where(F.col("timestamp_hour") < 4500 * 3_600_000)
    open_hour = spark.createDataFrame([("hot", None)], "product string, timestamp_hour bigint")
    assert not_in(keys, listed).count() == 4500
    # That product may be listed at any hour, so none of its rows surely differs.
    assert not_in(keys, listed.unionByName(open_hour)).count() == 3000
