"""Mixing sources to target weights by a curriculum that changes over training."""

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickmill.llm.common import keyed_rows, stored, word_count
from clickmill.llm.prefix import pieces_of, with_running_total

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
SLOPES = (-0.5, 0.0, 0.5)  # of the schedules: early, even, late

Schedule = Sequence[tuple[float, float]]


def targets(sizes: Mapping[str | None, int], weights: Sequence[int], most: int) -> dict[str | None, float]:
    """Words to take of each source, whose sum is that of all sizes.

    Sources in the order of code points, null last, weigh the weights in turn. No target is
    above `most` times its source's size; what is over goes to the others by weight. So a
    target is min(most * size, level * weight) for one level, and sources reach their limit
    in the order of size by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, left = sum(sizes.values()), sum(weight.values())
    limited, level = set(), 0.0
    for source in sorted(names, key=lambda s: (sizes[s] / weight[s], names.index(s))):
        level = rest / left
        if most * sizes[source] > level * weight[source]:
            break
        limited.add(source)
        rest -= most * sizes[source]
        left -= weight[source]
    return {s: float(most * sizes[s]) if s in limited else level * weight[s] for s in names}


def schedules(sources: Sequence[str | None]) -> dict[str | None, Schedule]:
    """A weight at the start and the end of training for each source: early, even and late in turn."""
    return {s: ((0.0, 1 - SLOPES[i % 3]), (1.0, 1 + SLOPES[i % 3])) for i, s in enumerate(sources)}


def invert_demand(schedule: Schedule, share: np.ndarray) -> np.ndarray:
    """Times in [0, 1] by which the schedule asks for the given shares of its whole demand.

    The weight is linear between knots, so the demand, its integral, is quadratic there.
    """
    time, weight = (np.array(x, float) for x in zip(*schedule))
    step = np.diff(time)
    demand = np.concatenate(([0.0], np.cumsum(step * (weight[1:] + weight[:-1]) / 2)))
    wanted = np.clip(share, 0, 1) * demand[-1]
    k = np.clip(np.searchsorted(demand, wanted, "right") - 1, 0, len(step) - 1)
    more, start = wanted - demand[k], weight[k]
    slope = (weight[k + 1] - start) / step[k]
    # The stable root of slope / 2 x^2 + start x = more.
    root = start + np.sqrt(np.maximum(0, start**2 + 2 * slope * more))
    return time[k] + np.where(root > 0, 2 * more / np.where(root > 0, root, 1), 0)


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_passes: int = MOST_PASSES,
    seed: str = "mix",
    schedule: Mapping[str | None, Schedule] | None = None,
) -> DataFrame:
    """How often and when training takes each of docs (doc_id, source, text).

    A source's documents follow one another in the order of MD5 of seed and doc_id, pass
    after pass, and are taken whole as long as their middle lies before the source's target.
    What a source has delivered by a time is the integral of its weight schedule, scaled to
    its target; inverting that gives the time of every copy.

    Returns doc_id, size (words; 0 for a null text), source, source_size, target, passes,
    taken (words) and positions, one time in [0, 1] for each pass, a row for each row of docs.
    A null source is a source. Sources without words have target 0 and are not taken.
    Sources are expected to be as few as a list of weights: their totals, a row each, come to
    the driver. Repeated rows are taken one by one; a null doc_id counts as empty text.
    """
    sized = stored(spark, docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    return _planned(spark, sized, weights, most_passes, seed, schedule).drop("_row_key", "_row_digest")


def _planned(
    spark: SparkSession,
    sized: DataFrame,
    weights: Sequence[int],
    most_passes: int,
    seed: str,
    schedule: Mapping[str | None, Schedule] | None = None,
) -> DataFrame:
    """The mix of stored rows (doc_id, source, size), and their _row_key and _row_digest if they have them."""
    keys = [c for c in ("_row_digest", "_row_key") if c in sized.columns]
    totals = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    sizes = {row["source"]: row["n"] for row in totals}
    target = targets(sizes, weights, most_passes)
    schedule = schedule or schedules(list(target))
    known = StructType(sized.schema.fields[1:2] + [StructField("source_size", LongType())])
    known = known.add("target", "double")
    plan = spark.createDataFrame([(s, sizes[s], target[s]) for s in target], known)
    joined = sized.alias("d").join(
        F.broadcast(plan.alias("p")), F.col("d.source").eqNullSafe(F.col("p.source"))
    ).select("d.doc_id", "d.source", "d.size", *[f"d.{c}" for c in keys], "p.source_size", "p.target")
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # A row for each source, and for its null one, with no key lost to null.
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    rows = sum(row["rows"] for row in totals)
    placed = with_running_total(joined, key, digest, F.col("size"), pieces_of(rows), [F.col(c) for c in ("doc_id", "size", *keys)], "before")

    def middle(turn: int) -> Column:
        return F.col("source_size") * turn + F.col("before") + F.col("size") / 2

    turns = [F.when(middle(k) < F.col("target"), middle(k) / F.col("target")) for k in range(most_passes)]
    placed = placed.withColumn("shares", F.array_compact(F.array(*turns)))

    @F.pandas_udf("array<double>")
    def times(source: pd.Series, shares: pd.Series) -> pd.Series:
        out = pd.Series([np.zeros(0)] * len(shares), index=shares.index)
        for one in source.unique():
            here = source.isna() if one is None or one != one else source == one
            own = schedule[None if one is None or one != one else one]
            flat = shares[here]
            lengths = flat.map(len)
            found = invert_demand(own, np.concatenate([*flat, np.zeros(0)]))
            out[here] = pd.Series(np.split(found, np.cumsum(lengths)[:-1]), index=flat.index)
        return out

    taken = F.col("size") * F.size("shares")
    return placed.select(
        *keys, "doc_id", "size", "source", "source_size", "target", F.size("shares").alias("passes"),
        taken.cast("long").alias("taken"), times("source", "shares").alias("positions"),
    )


def take(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_passes: int = MOST_PASSES,
    seed: str = "mix",
) -> DataFrame:
    """The documents as often as the mix takes them, range-sorted by training position.

    Every row is taken at positions of its own, rows without a doc_id or with the same one too.
    """
    rows = keyed_rows(spark, docs, _size=word_count())
    sized = rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), F.col("_size").alias("size"), "_row_digest", "_row_key")
    plan = _planned(spark, sized, weights, most_passes, seed).where("passes > 0")
    # No list is empty; a plain explode would filter for that, and find the times in Python twice, in two workers at once.
    plan = plan.select(F.col("_row_key").alias("_of"), F.explode_outer("positions").alias("_position"))
    joined = rows.select("_row_key", "_row").join(plan, F.col("_row_key") == F.col("_of"))
    return joined.orderBy("_position", "_row.doc_id", "_row_key").select("_row.*")
