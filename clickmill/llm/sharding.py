"""Sharding by sampled splitters."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import seeded_hash, stored

SEED = 6
RANGE_ROWS = 100_000  # that one range should hold
SAMPLES = 32  # for each range
WHOLE = 64  # a group of equal texts below this part of a shard is kept in one
ROUNDS = 8
FIRST = -(1 << 63)


def _ordered(rows: pd.DataFrame) -> np.ndarray:
    """key, place and row as 24 bytes that compare as they do."""
    numbers = rows[["key", "place", "row"]].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(numbers.astype(">u8")).view("S24").ravel()


def _numbers(ordered: np.ndarray) -> pd.DataFrame:
    """The inverse of `_ordered`."""
    numbers = np.frombuffer(ordered.astype("S24").tobytes(), ">u8").astype(np.uint64) ^ np.uint64(1 << 63)
    return pd.DataFrame(numbers.view(np.int64).reshape(-1, 3), columns=["key", "place", "row"])


def _splitters(sample: pd.DataFrame, ranges: int) -> np.ndarray:
    """Keys that cut the sample's weight in equal parts.

    A splitter within a group of equal texts moves to its start, unless the group spans more
    than one part.
    """
    sample = sample.sort_values(["key", "place", "row"], ignore_index=True)
    weight = sample["weight"].cumsum().to_numpy()
    at = np.searchsorted(weight, np.arange(1, ranges) * (weight[-1] / ranges)) if len(weight) else np.zeros(0, int)
    chosen = sample.iloc[np.unique(at)].copy()
    chosen.loc[~chosen["key"].duplicated(keep="first"), ["place", "row"]] = FIRST
    return np.unique(_ordered(chosen))


def _ranged(sized: DataFrame, splitters: np.ndarray) -> DataFrame:
    @F.pandas_udf("int")
    def of(key: pd.Series, place: pd.Series, row: pd.Series) -> pd.Series:
        rows = pd.DataFrame({"key": key, "place": place, "row": row})
        return pd.Series(np.searchsorted(splitters, _ordered(rows), "right").astype(np.int32))

    return sized.withColumn("range", of("key", "place", "row"))


def cut_ranges(sized: DataFrame, ranges: int, rows: int, total: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Splitters of rows (key, place, row, size), and range, rows and bytes of each range.

    A row weighs its size and the mean size, so that a range of twice its share at most holds
    neither too many bytes nor too many rows. Ranges above that are sampled and split again.
    """
    mean = total / rows
    share = 2 * total / ranges
    splitters, overfull = np.zeros(0, "S24"), None
    for turn in range(ROUNDS):
        step = share / SAMPLES / 4**turn
        chance = F.pmod(seeded_hash(SEED + turn, "key", "place", "row"), F.lit(1 << 30)) / float(1 << 30)
        candidates = sized if overfull is None else _ranged(sized, splitters).where(F.col("range").isin(overfull))
        weight = F.col("size") + mean
        sample = candidates.where(chance * step < weight).select("key", "place", "row", F.greatest(weight, F.lit(step)).alias("weight")).toPandas()
        parts = [sample] if overfull is None else [part for _, part in sample.groupby(np.searchsorted(splitters, _ordered(sample), "right"))]
        new = [_splitters(part, int(np.ceil(part["weight"].sum() / share))) for part in parts]
        before, splitters = len(splitters), np.unique(np.concatenate([splitters, *new]))
        found = _ranged(sized, splitters).groupBy("range").agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes")
        ).toPandas().sort_values("range")
        too_large = (found["bytes"] + mean * found["rows"] > 2 * share) & (found["rows"] > 1)
        overfull = found.loc[too_large, "range"].tolist()
        if not overfull or len(splitters) == before:
            break
    return splitters, found


def _spanning(splitters: np.ndarray, found: pd.DataFrame) -> pd.DataFrame:
    """key and start, in bytes before it, of each group that a splitter cuts; one stands at its start too."""
    inner = _numbers(splitters)
    inner = inner[(inner["row"] != FIRST) | (inner["place"] != FIRST)].drop_duplicates("key")
    first = np.searchsorted(splitters, _ordered(inner.assign(place=FIRST, row=FIRST)), "right")
    before = np.concatenate(([0], found["bytes"].cumsum().to_numpy(np.int64)))
    return pd.DataFrame({"key": inner["key"].to_numpy(), "start": before[np.searchsorted(found["range"].to_numpy(), first)]})


def shard(spark: SparkSession, docs: DataFrame, shards: int = 8) -> DataFrame:
    """Deal docs (doc_id, text) into shards of nearly equal bytes, equal texts together.

    Rows are ordered by a hash of the text, then doc_id, then a number of their own. A sample
    weighted by size gives splitters, which range-partition the rows; ranges that come out over
    twice their share of bytes and rows are sampled and split again. Exact totals of the ranges and a running total within each give
    every row its place, and equal stretches of bytes make the shards. A group of equal texts
    lies in one shard unless it is larger than a 64th of one; then it is dealt row by row.
    Only the sample and a row for each range come to the driver.

    Returns doc_id, size (UTF-8 bytes and 1; 1 for a null text), text_crc32, shard and slot
    (gapless from 0 in its shard), a row for each row of docs, repeated ones too. A null
    doc_id stands first in its group. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.lit(SEED)).alias("key"),
        F.coalesce("doc_id", F.lit(FIRST)).alias("place"),
        F.monotonically_increasing_id().alias("row"),
    )
    sized = stored(spark, sized, "sizes")
    whole = sized.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    rows, total = whole["rows"], whole["bytes"]
    if not rows:
        nothing = F.lit(None)
        return sized.select("doc_id", "size", "text_crc32", nothing.cast("int").alias("shard"), nothing.cast("long").alias("slot"))
    splitters, found = cut_ranges(sized, max(4 * shards, -(-rows // RANGE_ROWS)), rows, total)
    offsets = found.assign(byte_base=found["bytes"].cumsum() - found["bytes"], row_base=found["rows"].cumsum() - found["rows"])
    offsets = offsets[["range", "byte_base", "row_base"]].astype({"range": "int32", "byte_base": "int64", "row_base": "int64"})
    bases = spark.createDataFrame(offsets, "range int, byte_base long, row_base long")
    spanning = spark.createDataFrame(_spanning(splitters, found), "key long, start long")
    spanning = sized.join(F.broadcast(spanning), "key").groupBy("key", "start").agg(F.sum("size").alias("whole"))
    order = Window.partitionBy("range").orderBy("key", "place", "row")
    group = Window.partitionBy("range", "key")
    placed = (
        _ranged(sized, splitters)
        .join(F.broadcast(bases), "range")
        .join(F.broadcast(spanning), "key", "left")
        .withColumn("at", F.row_number().over(order) - 1 + F.col("row_base"))
        .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("byte_base"))
        .withColumn("group_bytes", F.coalesce("whole", F.sum("size").over(group)))
        .withColumn("group_end", F.coalesce(F.col("start") + F.col("whole"), F.max("end").over(group)))
    )
    kept = F.col("group_bytes") * (shards * WHOLE) <= total
    middle = F.when(kept, F.col("group_end") - F.col("group_bytes") / 2).otherwise(F.col("end") - F.col("size") / 2)
    number = F.least(F.floor(middle * shards / float(total)), F.lit(shards - 1)).cast("int")
    dealt = stored(spark, placed.select("doc_id", "size", "text_crc32", number.alias("shard"), "at"), "dealt")
    first = dealt.groupBy("shard").agg(F.min("at").alias("first"))
    slots = dealt.join(F.broadcast(first), "shard")
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).cast("long").alias("slot"))
