"""Running totals and ranks within keys of any size, without one task for a key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = 100_000  # of a key, that one window sees


def pieces_of(total: int) -> int:
    """Into how many ranges of hashed positions to cut every key."""
    return max(1, -(-total // ROWS))


def with_running_total(
    rows: DataFrame, key: Column, order: Column, value: Column, pieces: int, tie: list[Column], name: str
) -> DataFrame:
    """Add `name`, the sum of `value` over the rows of the same key that come before.

    order is a lower-case hexadecimal digest; `tie` orders rows that share one. A key's rows
    are cut in `pieces` ranges of the digest's first 32 bits. Totals of ranges, a row each,
    give what stands before a range; a window over the range does the rest. The result does
    not depend on the number of pieces.
    """
    prefix = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    cut = rows.select("*", key.alias("_key"), order.alias("_order"), value.alias("_value"))
    cut = cut.withColumn("_piece", F.shiftright(prefix * pieces, 32))
    before = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("_key", "_piece").agg(F.sum("_value").alias("_sum"))
    base = F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    sums = sums.select(base, F.col("_key").alias("_of"), F.col("_piece").alias("_at"))
    within = Window.partitionBy("_key", "_piece").orderBy("_order", *tie).rowsBetween(Window.unboundedPreceding, -1)
    joined = cut.join(sums, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_piece") == F.col("_at")))
    total = F.coalesce(F.sum("_value").over(within), F.lit(0)) + F.col("_base")
    return joined.withColumn(name, total).drop("_key", "_order", "_value", "_piece", "_base", "_of", "_at")
