"""Benchmark decontamination: passages of test items found in documents by a broadcast set of n-grams."""

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import stored, stretches, text_bytes

WINDOW = 10
PART_WORDS = 500_000  # of test items, that one broadcast set is made of
AT_ONCE = 4_000_000  # bytes of text, unless one text alone is longer
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # ASCII letters and digits, and all that is not ASCII
APART = bytes(b if WORD.match(bytes([b])) else 32 for b in range(256))
UNKNOWN = -1
SLOTS = 22  # bits of a hash that a first look-up tests


def words(text: bytes) -> list[bytes]:
    """The words of a text, with A-Z in lower case."""
    return text.lower().translate(APART).split()


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` numbers from every place on."""
    mixed = (ids.astype(np.int64).astype(np.uint64) + np.uint64(2)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(max(0, len(ids) - length + 1), np.uint64)
    for i in range(length):
        total = total * np.uint64(0xD6E8FEB86659FD93) + mixed[i : i + len(total)]
    total ^= total >> np.uint64(32)
    return total * np.uint64(0x9E3779B97F4A7C15)


class WindowSet:
    """The different windows of some items: `window` words that follow each other, or a whole item of fewer.

    Words are numbers here, and equal numbers are equal words. A window is looked up by its
    hash, first in a table of bits, then among the sorted hashes, and verified number by number.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, (_, text) in enumerate(items):
            ids = np.array([self.numbers.setdefault(word, len(self.numbers)) for word in words(text)], np.int32)
            if len(ids):
                length = min(window, len(ids))
                found.setdefault(length, []).append((item, np.lib.stride_tricks.sliding_window_view(ids, length)))
        self.names = np.array([name for name, _ in items], object)
        self.tables = {length: self._table(length, parts) for length, parts in found.items()}

    @staticmethod
    def _table(length: int, parts: list[tuple[int, np.ndarray]]) -> tuple:
        windows, which = np.unique(np.concatenate([w for _, w in parts]), axis=0, return_inverse=True)
        hashes = _hashes(windows.ravel(), length)[::length]
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        item = np.repeat([i for i, _ in parts], [len(w) for _, w in parts])
        pairs = np.unique(np.column_stack([rank[which.ravel()], item]), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))
        hashes = hashes[order]
        known = np.zeros(1 << SLOTS, bool)
        known[hashes >> np.uint64(64 - SLOTS)] = True
        alike = int(np.unique(hashes, return_counts=True)[1].max())
        return hashes, windows[order], first, pairs[:, 1], known, alike

    def ids(self, texts: list[list[bytes]]) -> np.ndarray:
        """The numbers of all words of the texts, with one that is no word's after every text."""
        own = chain.from_iterable(chain(text, (b"",)) for text in texts)
        return np.fromiter(map(self.numbers.get, own, repeat(UNKNOWN)), np.int32, sum(map(len, texts)) + len(texts))

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every length of windows: the length, where in ids windows occur, and which ones."""
        for length, (hashes, windows, _, _, known, alike) in self.tables.items():
            own = _hashes(ids, length)
            place = np.flatnonzero(known[own >> np.uint64(64 - SLOTS)])
            low = np.searchsorted(hashes, own[place])
            for entry in (low + step for step in range(alike)):  # different windows may share a hash
                entry = np.minimum(entry, len(hashes) - 1)
                same = (ids[place[:, None] + np.arange(length)] == windows[entry]).all(axis=1)
                yield length, place[same], entry[same]

    def items(self, length: int, entries: np.ndarray) -> set[str]:
        """The names of the items that hold any of these windows."""
        _, _, first, of, _, _ = self.tables[length]
        names = (self.names[of[first[e] : first[e + 1]]] for e in np.unique(entries))
        return {name for some in names for name in some if name is not None}


def search(texts: list[bytes], windows: WindowSet, spans: list[list[int]]) -> Iterator[tuple[int, list[int], set[str]]]:
    """For every text: its number of words, the spans of hit words, and the names of the items found.

    Spans are ranges of words that do not touch, [start, end, start, end, ...]; those given are
    hit already.
    """
    split = [words(text) for text in texts]
    ids = windows.ids(split)
    length = np.fromiter(map(len, split), np.int64, len(split))
    first = np.cumsum(length + 1) - length - 1
    change = np.zeros(len(ids) + 1, np.int32)
    before = np.array([edge + start for s, start in zip(spans, first.tolist()) for edge in s], np.int64)
    np.add.at(change, before[::2], 1)
    np.add.at(change, before[1::2], -1)
    names: dict[int, set[str]] = {}
    for n, place, entry in windows.hits(ids):
        np.add.at(change, place, 1)
        np.add.at(change, place + n, -1)
        text = np.searchsorted(first, place, "right") - 1
        cuts = np.flatnonzero(np.diff(text)) + 1
        for at, entries in zip(text[np.concatenate(([0], cuts))] if len(text) else [], np.split(entry, cuts)):
            names.setdefault(int(at), set()).update(windows.items(n, entries))
    hit = np.cumsum(change) > 0
    edges = np.flatnonzero(np.diff(hit, prepend=False))
    parts = np.split(edges, np.searchsorted(edges, first[1:])) if len(first) else []
    for i, (n, start, part) in enumerate(zip(length.tolist(), first.tolist(), parts)):
        yield n, (part - start).tolist(), names.get(i, set())


def _scanned(rows: DataFrame, windows: Broadcast) -> DataFrame:
    """rows (row, bytes, n_words, spans, items) with what one set of windows adds to spans and items."""
    kinds = {"n_words": pa.int64(), "spans": pa.list_(pa.int64()), "items": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch, "bytes", AT_ONCE):
                found = list(search(part["bytes"].to_pylist(), windows.value, part["spans"].to_pylist()))
                items = [sorted(new.union(old)) for (_, _, new), old in zip(found, part["items"].to_pylist())]
                columns = dict(zip(kinds, ([n for n, _, _ in found], [s for _, s, _ in found], items)))
                arrays = [pa.array(columns[name], kinds[name]) if name in columns else part[name] for name in batch.schema.names]
                yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def find(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None
) -> DataFrame:
    """Which words of docs (text, ...) stand in passages of benchmark (item_id, text).

    A word is hit if it lies in `window` words that follow each other in an item too, or in the
    words of a whole item that has fewer. Returns for every row of docs: row, a struct of its
    columns (those in `keep`), n_words, n_hit, spans (hit ranges of words, [start, end, ...]) and
    items (the ids of the items found, as strings in order). Null and empty texts have no words,
    and neither do such items; an item without an id hits words but is not listed, and items
    of one id are one. Empty tables give no rows, or no hits.

    The windows are broadcast as a set. A set is made of about PART_WORDS words of items; more
    of them go over the documents one after the other, each adding to what the ones before found.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_bytes().alias("text")).distinct()
    items = stored(spark, items.select("*", F.length("text").alias("size")), "items")
    # A word and the gap after it take two bytes at least; six are usual.
    parts = max(1, -(-(items.agg(F.sum("size")).first()[0] or 0) // (6 * PART_WORDS)))
    row = F.struct(*(F.col(f"`{name}`") for name in keep or docs.columns)).alias("row")
    none = [F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items")]
    rows = docs.select(row, text_bytes().alias("bytes"), *none)
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).select("item_id", "text").collect()
        windows = spark.sparkContext.broadcast(WindowSet([(r["item_id"], bytes(r["text"])) for r in chosen], window))
        rows = _scanned(rows, windows)
        if part < parts - 1:
            rows = stored(spark, rows, "scanned")
    # Subtracting in turn leaves the sum of the ends less that of the starts.
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, edge: edge - total)
    return rows.select("row", "n_words", n_hit.alias("n_hit"), "spans", "items")


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs in which no passage of an item stands, with all their columns."""
    return find(spark, docs, benchmark, window).where("n_hit = 0").select("row.*")


def without(text: bytes, spans: list[int]) -> bytes:
    """The text without the given ranges of words: each goes from its first word's start to its last one's end."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    kept, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def clean_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of docs, with all their columns; from each text the hit words go, and what stands between those of a range."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without(t.encode(), list(s)).decode() if len(s) else t for t, s in zip(texts, spans)], dtype=object)

    rows = find(spark, docs, benchmark, window)
    text = F.when(F.col("n_hit") > 0, cut("row.text", "spans")).otherwise(F.col("row.text"))
    return rows.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
