"""What several operators share: tables, words, stored intermediate results, components."""

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.session import new_folder
from clickmill.sources.folders import delete


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: list[str] = []  # folders that `stored` has made in this process and `discard` has not deleted


def stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: a lost executor costs no recomputation."""
    path = new_folder(spark, label)
    _made.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def made() -> set[str]:
    """The folders of stored rows that still exist."""
    return set(_made)


def discard(spark: SparkSession, folders: set[str]) -> None:
    """Delete stored rows that no result still to be computed is made from."""
    for path in folders & set(_made):
        delete(spark, path)
        _made.remove(path)


TEXTS_AT_ONCE = 500  # rows with whole texts passed to Python at once


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int = TEXTS_AT_ONCE) -> Iterator[None]:
    """Whatever runs inside passes at most so many rows at once to Python: whole texts take room on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_memory() -> None:
    """Give memory that earlier tasks of this Python worker have freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def keyed_rows(spark: SparkSession, rows: DataFrame, **more: Column) -> DataFrame:
    """Every row whole in _row, under a _row_key of its own and a _row_digest of all its columns, stored with further columns."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    key = [F.monotonically_increasing_id().alias("_row_key"), F.xxhash64(*columns).alias("_row_digest"), F.struct(*columns).alias("_row")]
    return stored(spark, rows.select(*key, *[column.alias(name) for name, column in more.items()]), "rows")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than 0x20 and 0x09 to 0x0D, with A-Z in lower case; both are what bytes' methods do."""
    return text.lower().split()


def word_count(column: str = "text") -> Column:
    """Number of runs of characters other than 0x20 and 0x09 to 0x0D; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded_hash(seed: int, *columns: str) -> Column:
    """A reproducible 64-bit number that depends on the columns and the seed."""
    return F.xxhash64(*columns, F.lit(seed))


def share_of(bound: int, total: int, seed: int, *columns: str) -> Column:
    """A condition that about `bound` of `total` rows meet, the same ones in every run."""
    share = min(1.0, bound / max(1, total))
    return F.pmod(seeded_hash(seed, *columns), F.lit(1 << 30)) < int(share * (1 << 30))


def map_rows(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """Apply a function from a batch of rows (pyarrow) to any number of dicts of columns."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in function(batch):
                arrays = [pa.array(columns[n], kinds[t]) for n, t in zip(names, types)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, schema)


def stretches(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose values of a binary or list column have about `size` bytes or elements, at least a row each."""
    values = batch[column]
    length = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(length, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_components(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to size - 1 and links between them: the smallest node each can reach."""
    label = np.arange(size)
    while True:
        smaller = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], smaller)
        np.minimum.at(label, label[right], smaller)
        label = label[label]
        if np.array_equal(label, before):
            return label


HUB = 100_000  # links of a node that one task may hold


def _with_smallest(links: DataFrame, total: int) -> DataFrame:
    """Add m, the smallest b of each a. Nodes of very many links are joined by broadcast, of which there are at most 2,000."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    if total <= HUB:  # no node can have more
        return links.join(smallest.select("a", "m"), "a")
    hubs = F.broadcast(smallest.where(F.col("n") > max(HUB, total // 1000)).select("a", "m"))
    others = links.join(hubs.select("a"), "a", "left_anti").join(smallest.select("a", "m"), "a")
    return links.join(hubs, "a").unionByName(others)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): every linked node with the smallest it can reach.

    Large-star and small-star steps alternate until all links point at a component's root.
    Each step is a grouped minimum and a join, and its links are stored, so nothing gathers
    on the driver. Null ends and loops are ignored. Returns node, root; nodes without a link
    are absent.
    """
    def ends(a, b):
        return [F.col(a).alias("a"), F.col(b).alias("b")]

    apart = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(spark, apart.distinct(), "links")
    summary = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20, 0)"))]
    state = links.agg(*summary).first()
    while True:
        both = links.select(*ends("a", "b")).unionAll(links.select(*ends("b", "a")))
        near = _with_smallest(both, state[0]).where("b > a")
        large = near.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        small = _with_smallest(large, state[0])
        below = small.where("b <> m").select(*ends("b", "m"))
        links = stored(spark, below.unionAll(small.select(*ends("a", "m"))).distinct(), "links")
        before, state = state, links.agg(*summary).first()
        if state == before:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
