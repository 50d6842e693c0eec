"""Hourly counts with bounded state: an hour is forgotten once the watermark has passed it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.aggregates import action_counts
from clickmill.operators.sketches import estimate_visitors
from clickmill.schema import COUNTS


def watermarked_counts(activity: DataFrame, delay: str) -> DataFrame:
    """activity_by_product for a stream whose clicks are at most `delay` out of order.

    In update mode an hour's counts are sent whenever they change, in append mode once, when
    the newest event time seen is `delay` past the hour's end. Clicks that come later than
    that are not counted, so the delay must cover their disorder.
    """
    return watermarked(activity, delay, action_counts(), COUNTS)


def watermarked_sketches(activity: DataFrame, delay: str) -> DataFrame:
    """visitor_sketches with bounded state: an hour's sketch is forgotten like its counts."""
    return watermarked(activity, delay, [F.hll_sketch_agg("visitor").alias("visitors")], ["visitors"])


def watermarked_visitors(activity: DataFrame, delay: str) -> DataFrame:
    """approx_visitors_by_product with bounded state."""
    return estimate_visitors(watermarked_sketches(activity, delay))


def watermarked(activity: DataFrame, delay: str, aggregates: list[Column], names: list[str]) -> DataFrame:
    """Aggregates of each product and hour until the watermark has passed the hour."""
    timed = activity.withColumn("event_ts", F.timestamp_millis("eventtime"))
    counted = (
        timed.withWatermark("event_ts", delay)
        .groupBy("product", F.window("event_ts", "1 hour").alias("hour"))
        .agg(*aggregates)
    )
    return counted.select(
        "product", F.unix_millis("hour.start").alias("timestamp_hour"), *names
    )
