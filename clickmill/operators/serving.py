"""Merging the batch and speed tables, both of one row per (product, timestamp_hour)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.operators.aggregates import key_order
from clickmill.schema import COUNTS, KEYS

SALTS = 16


def apply_updates(base: DataFrame, speed: DataFrame) -> DataFrame:
    """Every base row, with the counts of the matching speed row added."""
    added = speed.select(*KEYS, *(F.col(name).alias(f"_{name}") for name in COUNTS))
    return base.join(added, KEYS, "left").select(
        *KEYS,
        *((F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in COUNTS),
    )


def missing_rows(base: DataFrame, speed: DataFrame) -> DataFrame:
    """Speed rows whose key the base table lacks. Keys are not NULL in a keyed table."""
    return speed.join(base.select(*KEYS), KEYS, "left_anti")


def merge(
    batch: DataFrame, speed: DataFrame, cutoff_hour: int | None = None, ordered: bool = False
) -> DataFrame:
    """Update and insert in one shuffle: add up the rows of both tables by key.

    Without a cutoff the counts are simply added, so the tables must cover separate events.
    With one, batch rows count before that hour and speed rows from it on; both filters
    reach the scans. `ordered` gives the result in key order and still shuffles once: rows
    partitioned by ranges of the key can be added up where they are.
    """
    if cutoff_hour is not None:
        batch = batch.where(F.col("timestamp_hour") < cutoff_hour)
        speed = speed.where(F.col("timestamp_hour") >= cutoff_hour)
    columns = KEYS + COUNTS
    both = batch.select(columns).unionByName(speed.select(columns))
    if ordered:
        both = both.repartitionByRange(*key_order())
    merged = both.groupBy(*KEYS).agg(*(F.sum(name).alias(name) for name in COUNTS))
    return merged.sortWithinPartitions(*key_order()) if ordered else merged


def merge_in_place(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """The additive merge as a full join, which tables in equal buckets of the key need no shuffle for."""
    ours, theirs = batch.alias("a"), speed.alias("b")
    same = (F.col("a.product") == F.col("b.product")) & (F.col("a.timestamp_hour") == F.col("b.timestamp_hour"))
    keys = [F.coalesce(f"a.{name}", f"b.{name}").alias(name) for name in KEYS]
    sums = [(F.coalesce(f"a.{n}", F.lit(0)) + F.coalesce(f"b.{n}", F.lit(0))).alias(n) for n in COUNTS]
    return ours.join(theirs, same, "full").select(*keys, *sums)


def not_in(rows: DataFrame, listed: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """SQL's `(a, b) NOT IN (SELECT a, b FROM listed)` for NULLs on either side.

    SQL keeps a row only if it surely differs from every listed pair, and NULL may equal
    anything. Spark plans that test as a nested loop over all pairs; here each way to
    match is an equality join, and a row with no key left to join on asks only whether a
    listed row of the right shape exists. Of listed rows with a NULL only the distinct values
    of the other column count. Where whole rows are tested by that one column, a salt made of
    the other spreads its hot values.
    """
    a, b = (F.col(key) for key in keys)
    listed = listed.select(a.alias("_a"), b.alias("_b"))
    _a, _b = F.col("_a"), F.col("_b")
    # At most one row for each value that stands beside a NULL.
    no_a = listed.where(_a.isNull()).select("_b").distinct()
    no_b = listed.where(_b.isNull()).select("_a").distinct()
    equal = {"_a": a == _a, "_b": b == _b}

    def without(rows, listed, *columns):
        on = [equal[column] for column in columns]
        return rows.join(listed.select(*columns).distinct(), on, "left_anti")

    def without_salted(rows, values, column, key, other):
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = rows.withColumn("_salt", F.pmod(F.hash(other), F.lit(SALTS)))
        values = values.where(F.col(column).isNotNull()).withColumn("_of", salts)
        return salted.join(values, (key == F.col(column)) & (F.col("_salt") == F.col("_of")), "left_anti").drop("_salt")

    whole = rows.where(a.isNotNull() & b.isNotNull())
    whole = without(whole, listed.where(_a.isNotNull() & _b.isNotNull()), "_a", "_b")
    whole = without_salted(without_salted(whole, no_b, "_a", a, b), no_a, "_b", b, a)
    whole = whole.where(~no_a.where(_b.isNull()).exists())

    only_a = rows.where(a.isNotNull() & b.isNull()).where(~no_a.exists())
    only_b = rows.where(a.isNull() & b.isNotNull()).where(~no_b.exists())
    neither = rows.where(a.isNull() & b.isNull()).where(~listed.exists())
    return (
        whole.unionByName(without(only_a, listed, "_a"))
        .unionByName(without(only_b, listed, "_b"))
        .unionByName(neither)
    )
