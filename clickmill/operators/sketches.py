"""Unique visitors that can be added up: exact distinct counts cannot."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.schema import KEYS


def visitor_sketches(activity: DataFrame) -> DataFrame:
    return activity.groupBy(*KEYS).agg(F.hll_sketch_agg("visitor").alias("visitors"))


def merge_sketches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One sketch per key from sketch tables of separate event sets."""
    together = reduce(DataFrame.unionByName, [table.select(*KEYS, "visitors") for table in (first, *others)])
    return together.groupBy(*KEYS).agg(F.hll_union_agg("visitors").alias("visitors"))


def serve_sketches(batch: DataFrame, speed: DataFrame, cutoff_hour: int | None = None) -> DataFrame:
    """One sketch per key of the batch and the speed layer, in one shuffle of sketches.

    A visitor that both layers saw counts once, so batch hours need no end. With a cutoff, speed
    rows count from that hour on, and others are not read.
    """
    if cutoff_hour is not None:
        speed = speed.where(F.col("timestamp_hour") >= cutoff_hour)
    return merge_sketches(batch, speed)


def estimate_visitors(sketches: DataFrame) -> DataFrame:
    return sketches.select(*KEYS, F.hll_sketch_estimate("visitors").alias("unique_visitors"))


def approx_visitors_by_product(activity: DataFrame) -> DataFrame:
    """Approximate unique visitors; unlike the exact count, Spark allows it on a stream."""
    return estimate_visitors(visitor_sketches(activity))
