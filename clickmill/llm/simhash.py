"""SimHash near-duplicates: pivot distance tables over the fingerprints."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import arrow_rows, components, keyed_rows, local_components, seeded_hash, stored, text_bytes, words

SEED = 42
REFERENCES = 24
GROUP = 1024  # fingerprints of one part of a large group
LINKS = 1 << 20  # links held in a task before they are reduced


def fingerprint(text: bytes, size: int) -> int:
    """The 64-bit SimHash of a text's shingles of `size` words, as a signed number.

    Fewer words make one shingle; none make fingerprint 0. A bit is 1 if set in over half
    of the hashes.
    """
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(found) - size + 1)
    spans = zip(starts[:count].tolist(), ends[-count:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", count)
    ones = np.zeros(64, np.int64)
    for part in range(0, count, 1 << 16):
        block = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def _print_of_text(size: int) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: fingerprint(text, size)).astype("int64")

    return of(text_bytes())


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and fp of every row; a null text is an empty one."""
    return docs.select("doc_id", _print_of_text(size).alias("fp"))


def references(count: int = REFERENCES) -> np.ndarray:
    """Reference fingerprints: random, hence about 32 bits apart."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, count, dtype=np.uint64)


def distance_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint to every reference; a row for each reference."""
    return np.bitwise_count(prints[None, :] ^ pivots[:, None]).astype(np.int8)


def linked_pairs(
    prints: np.ndarray, end: np.ndarray, distance: int, pivots: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j < end[i] whose fingerprints differ in at most `distance` bits.

    By the triangle inequality the distances to any reference differ by no more than the pair
    itself; a pair that differs more in one coordinate is discarded, the rest is verified.
    """
    near = distance_table(prints, pivots)
    first = np.arange(len(prints))
    for step in range(1, len(prints)):
        first = first[first + step < end[first]]
        if not len(first):
            return
        i = first
        for row in near:
            i = i[np.abs(row[i] - row[i + step]) <= distance]
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= distance]
        if len(i):
            yield i, i + step


def _blocks(count: int, distance: int) -> int:
    """Number of blocks of bits such that those surely equal in a pair tell apart `count` fingerprints."""
    blocks = distance + 2
    while blocks < 2 * distance and count > 8 << (64 * (blocks - distance) // blocks):
        blocks += 1
    return blocks


def _masks(blocks: int, distance: int) -> list[int]:
    """Bits of every choice of blocks - distance blocks, as signed numbers."""
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    block = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges, edges[1:])]
    sums = [sum(chosen) for chosen in combinations(block, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def links(spark: SparkSession, prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` within `distance` bits.

    Two such fingerprints agree in all bits of at least blocks - distance blocks, so they meet
    in a group for one choice of blocks. In each group the pivot table decides. Groups above
    GROUP members are cut in parts and all pairs of parts compared, so no task holds more than
    two parts. What leaves a group is its components as stars, not its pairs.
    """
    masks = _masks(_blocks(prints.count(), distance), distance)
    groups = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(m).alias("bits")) for i, m in enumerate(masks)])
    keyed = prints.select("fp", F.explode(groups).alias("g")).select("fp", "g.*")
    sizes = keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / GROUP).cast("int")
    part = F.pmod(seeded_hash(SEED, "fp"), F.col("parts")).cast("int")
    dealt = (
        keyed.join(sizes, ["mask", "bits"])
        .select("fp", "mask", "bits", parts.alias("parts"))
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", "mask", "bits", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    )
    group = ["mask", "bits", "low", "high"]
    pivots = references()

    def stars(prints: np.ndarray, end: np.ndarray) -> pd.DataFrame:
        held = [(np.zeros(0, int), np.zeros(0, int))]
        root = np.arange(len(prints))
        for pair in linked_pairs(prints, end, distance, pivots):
            held.append(pair)
            if sum(len(i) for i, _ in held) > LINKS:
                root = local_components(len(prints), *map(np.concatenate, zip(*held)))
                held = [(np.arange(len(prints)), root)]
        root = local_components(len(prints), *map(np.concatenate, zip(*held)))
        leaf = np.flatnonzero(root != np.arange(len(prints)))
        return pd.DataFrame({"a": prints[leaf].view(np.int64), "b": prints[root[leaf]].view(np.int64)})

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame])
            keys = frame[group].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            rest, done = frame.iloc[starts[-1] :], starts[-1]
            if done:
                end = np.repeat(starts[1:], np.diff(starts))
                yield stars(frame["fp"].to_numpy()[:done].view(np.uint64), end)
        if rest is not None:
            yield stars(rest["fp"].to_numpy().view(np.uint64), np.full(len(rest), len(rest)))

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(join, "a long, b long")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle_words: int = 4, max_bits: int = 4
) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row of docs (doc_id, text).

    component_id is the smallest doc_id reachable by links of at most max_bits bits. Copies
    share a fingerprint and count once in the search. Null and empty texts have fingerprint
    0, linked like any other; rows without a doc_id link too, and get a null component_id
    only where no linked row has a doc_id. Repeated rows give repeated results.
    """
    with arrow_rows(spark):
        prints = stored(spark, fingerprints(docs, shingle_words), "fingerprints")
    known = _classes(spark, prints, max_bits)
    return prints.join(known, "fp").select("doc_id", "fp", "component_id")


def _classes(spark: SparkSession, prints: DataFrame, max_bits: int) -> DataFrame:
    """fp, root and component_id of every fingerprint of prints (doc_id, fp): one root for each group."""
    distinct = stored(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(spark, links(spark, distinct.select("fp"), max_bits))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stored(spark, placed.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def keep_one(spark: SparkSession, docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each group, of its smallest doc_id, with all columns.

    A row without a doc_id stays only if its group has no row with one. Of rows that share a
    doc_id, those of one group are one document, those of different groups all stay.
    """
    with arrow_rows(spark):
        rows = keyed_rows(spark, docs, _fp=_print_of_text(shingle_words))
    slim = rows.select("_row_key", "_row_digest", F.col("_row.doc_id").alias("doc_id"), F.col("_fp").alias("fp"))
    known = _classes(spark, slim.select("doc_id", "fp"), max_bits)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row_digest", "_row_key")
    best = slim.groupBy("fp").agg(F.min(place).alias("best")).join(known, "fp")
    kept = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best._row_key").alias("_kept"))
    return rows.join(kept, F.col("_row_key") == F.col("_kept"), "left_semi").select("_row.*")
