"""Aggregates per product and hour. All reduce rows before the shuffle, so a hot key is cheap."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.schema import COUNTED_ACTIONS, KEYS


def action_counts() -> list[Column]:
    return [
        F.sum(F.when(F.col("action") == action, 1).otherwise(0)).alias(name)
        for name, action in COUNTED_ACTIONS.items()
    ]


def activity_by_product(activity: DataFrame) -> DataFrame:
    """Purchases, cart additions and page views; other actions only open their group."""
    return activity.groupBy(*KEYS).agg(*action_counts())


def visitors_by_product(activity: DataFrame) -> DataFrame:
    """Exact unique visitors. The first shuffle is by key and visitor, which spreads a hot key."""
    return activity.groupBy(*KEYS).agg(F.countDistinct("visitor").alias("unique_visitors"))


def rollup_by_product(activity: DataFrame) -> DataFrame:
    """The counts and the exact unique visitors of each key from one scan.

    The sums ride along with the distinct count's two shuffles.
    """
    return activity.groupBy(*KEYS).agg(
        *action_counts(), F.countDistinct("visitor").alias("unique_visitors")
    )


def distinct_keys(activity: DataFrame) -> DataFrame:
    return activity.select("timestamp_hour", "product").distinct()


def first_rows(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key.

    Spark applies the rank limit before the shuffle as well, so each task sends at most
    n rows per key however many it holds (for n up to 1000, the default of
    spark.sql.optimizer.windowGroupLimitThreshold).
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where(f"_rank <= {n}").drop("_rank")


def last_write_per_key(rows: DataFrame, order: list[str], keys: list[str] = KEYS) -> DataFrame:
    """The row a keyed table would hold: the latest by `order`, whose last column breaks ties.

    The hour leads the sort: comparing numbers is cheaper than comparing product names, and
    rows in time order compress better on their way through the shuffle.
    """
    return first_rows(rows, keys[::-1], [F.desc(name) for name in order], 1)


def latest_hours(table: DataFrame, n: int) -> DataFrame:
    """The newest n hours of each product, from a table with one row per key."""
    return first_rows(table, ["product"], [F.desc("timestamp_hour")], n)


def key_order() -> list[Column]:
    """By product, newest hour first."""
    return [F.col("product").asc(), F.col("timestamp_hour").desc()]


def in_key_order(table: DataFrame) -> DataFrame:
    """Rows in ranges of the key, sorted, for the files of a keyed table.

    Ranges cover both key columns, so one product may span several files; row-group
    statistics then let a product lookup skip the rest.
    """
    return table.repartitionByRange(*key_order()).sortWithinPartitions(*key_order())
