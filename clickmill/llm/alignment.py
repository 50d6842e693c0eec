"""Alignment of two tokenizers' tokens by galloping intersection of their end offsets."""

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from clickmill.llm.common import stored, stretches, text_bytes
from clickmill.llm.packing import BYTE_LEVEL

AT_ONCE = 500_000  # bytes of text, unless one text alone is longer
PAIRS_AT_ONCE = 500_000  # of stored links
PART_PAIRS = 1_000_000  # pairs of ids that one broadcast table holds
# Fixed value: how byte-level tokenizers cut a text before they merge.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SETTLED = re.compile(r"[\x00-ɏ]*")  # letters that all libraries take for such


class ByteTokens:
    """Ids by a byte-level vocabulary; strings of special tokens are ordinary text.

    A vocabulary of this kind numbers its entries in the order of their merges, so the entries
    alone tell the ids, which the faster of two libraries works out. Texts with letters that might
    be too new for one of them go to the tokenizer that the file states. Tokens always give
    back their text, as every byte is an entry.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        self.tokenizer = None
        with open(path) as file:
            stated = json.load(file)
        byte_of = {chr(BYTE_LEVEL.get(byte, byte)): byte for byte in range(256)}
        special = {token["id"] for token in stated["added_tokens"]}
        vocabulary = stated["model"]["vocab"]
        self.bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(byte_of[c] for c in token)
        ranks = {self.bytes[number]: number for number in vocabulary.values() if number not in special}
        self.fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if SETTLED.fullmatch(text):
            return self.fast.encode_to_numpy(text).astype(np.int64)
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)


class PieceTokens:
    """Ids by a piece vocabulary with byte fallback, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.pieces.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.pieces.encode(text, num_threads=1)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every end in `short`, where in `long` the first end that is not smaller stands.

    Both are sorted and finish with the same end. Every search starts where the end would
    stand if the tokens of both were of even length, doubles its steps until it has passed the
    end, and halves what lies between; all ends take their steps together.
    """
    low = high = np.arange(len(short)) * len(long) // max(1, len(short))
    step = 1
    while True:
        down, up = (low > 0) & (long[low] >= short), long[high] < short
        if not (down.any() or up.any()):
            break
        # What lies below the end bounds the answer from below, what does not from above.
        high = np.where(down, low, high)
        low = np.where(up, high, np.where(down, np.maximum(low - step, 0), low))
        high = np.where(up, np.minimum(high + step, len(long) - 1), high)
        step *= 2
    while (low < high).any():
        middle = (low + high) // 2
        below = long[middle] < short
        low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
    return high


class Alignment(NamedTuple):
    """Token ids of both sides, the tokens before each common end, and the links as places in both."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    a_links: np.ndarray
    b_links: np.ndarray


def overlaps(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, ...]:
    """From the ends of both: places of the common ones in each, and of all pairs of tokens that overlap."""
    place = gallop(short, long)
    common = long[place] == short
    # A token reaches from the token that holds its first byte to the one that holds its last.
    first = np.concatenate(([0], (place + common)[:-1]))[: len(place)]
    count = place - first + 1
    end = np.cumsum(count)
    whole = end[-1] if len(end) else 0
    return np.flatnonzero(common), place[common], np.repeat(np.arange(len(short)), count), np.repeat(first - end + count, count) + np.arange(whole)


class Aligner:
    """Aligns texts by two vocabularies; the second one's tokens have the space before the text."""

    def __init__(self, a_path: str, b_path: str):
        self.sides = ByteTokens(a_path), PieceTokens(b_path)
        self.lengths = [np.array([len(t) for t in side.bytes]) for side in self.sides]
        # Ids as text, with what follows them inside a group and at its end.
        self.shown = [[np.array([f"{i}{mark}" for i in range(len(side.bytes))], object) for mark in marks] for side, marks in zip(self.sides, (",|", ",;"))]

    def align(self, text: bytes) -> Alignment | None:
        """None for a text without tokens: an empty one, or one whose tokens do not give it back."""
        if not text:
            return None
        words = text.decode(errors="replace")
        a, pieces = self.sides[0].ids(" " + words), self.sides[1].ids(words)
        if b"".join(map(self.sides[1].bytes.__getitem__, pieces)) != b" " + text:
            return None
        b = np.array(pieces, np.int64)
        a_ends, b_ends = (np.cumsum(lengths[i]) for lengths, i in zip(self.lengths, (a, b)))
        if len(a) <= len(b):
            a_common, b_common, a_links, b_links = overlaps(a_ends, b_ends)
        else:
            b_common, a_common, b_links, a_links = overlaps(b_ends, a_ends)
        return Alignment(a, b, a_common + 1, b_common + 1, a_links, b_links)

    def groups(self, found: Alignment) -> str:
        """The groups as text: ids of both sides, `a1,a2|b1;a3|b2,b3`."""
        places, parts = [], []
        cuts = [np.concatenate(([0], c)) for c in (found.a_cuts, found.b_cuts)]
        for side, (ids, own, other) in enumerate(((found.a, cuts[0], cuts[1][:-1]), (found.b, cuts[1], cuts[0][1:]))):
            # Before a token stand the earlier ones of its side, and the other's of the groups before it.
            places.append(np.arange(len(ids)) + np.repeat(other, np.diff(own)))
            shown = self.shown[side][0][ids]
            shown[own[1:] - 1] = self.shown[side][1][ids[own[1:] - 1]]
            parts.append(shown)
        whole = np.empty(len(found.a) + len(found.b), object)
        for place, shown in zip(places, parts):
            whole[place] = shown
        return "".join(whole)[:-1]


def _mapped(docs: DataFrame, keep: list[str] | None, a_path: str, b_path: str, describe, fields: dict[str, tuple]) -> DataFrame:
    """row, a struct of columns of docs, and what describe(aligner, alignment or None) gives for its text."""
    row = F.struct(*(F.col(f"`{name}`") for name in keep or docs.columns)).alias("row")
    rows = docs.select(row, text_bytes().alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            for part in stretches(batch, "bytes", AT_ONCE):
                found = [describe(aligner, aligner.align(text)) for text in part["bytes"].to_pylist()]
                arrays = [pa.array([f[i] for f in found], kind) for i, (kind, _) in enumerate(fields.values())]
                yield pa.RecordBatch.from_arrays([part["row"], *arrays], ["row", *fields])

    return rows.mapInArrow(run, StructType([rows.schema["row"], *(StructField(name, kind) for name, (_, kind) in fields.items())]))


INTS = (pa.list_(pa.int32()), ArrayType(IntegerType()))
LONG = (pa.int64(), LongType())
TEXT = (pa.string(), StringType())


def groups(docs: DataFrame, a_path: str, b_path: str, keep: list[str] | None = None) -> DataFrame:
    """Every row of docs (text, ...) with the ids by both tokenizers and the groups that common ends cut them into.

    Returns row, a struct of the columns of docs (those in `keep`), a and b, the ids, a_cuts and
    b_cuts, how many of them lie before the end of each group. a is of the text with a space
    before it, b of the text. Special tokens' strings are ordinary text. A null or empty text has no
    tokens, nor has one whose tokens do not give back its bytes on both sides.
    """
    def describe(_, found):
        return ([], [], [], []) if found is None else found[:4]

    return _mapped(docs, keep, a_path, b_path, describe, {"a": INTS, "b": INTS, "a_cuts": INTS, "b_cuts": INTS})


def links(docs: DataFrame, a_path: str, b_path: str, keep: list[str] | None = None) -> DataFrame:
    """The groups of every row of docs as a digest, and its links by pairs of ids.

    A link is a token of each side whose bytes overlap. Returns row as in `groups`, n_a, n_b,
    n_groups, n_links, groups_sha256 of the groups as text (an empty one without tokens), and
    link_a, link_b, times: the different linked pairs of ids and how often each occurs.
    """
    def describe(aligner, found):
        if found is None:
            return 0, 0, 0, 0, "", [], [], []
        pairs, times = np.unique(found.a[found.a_links] << 32 | found.b[found.b_links], return_counts=True)
        digest = sha256(aligner.groups(found).encode()).hexdigest()
        return len(found.a), len(found.b), len(found.a_cuts), len(found.a_links), digest, pairs >> 32, pairs & 0xFFFFFFFF, times

    counts = dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), LONG)
    return _mapped(docs, keep, a_path, b_path, describe, counts | {"groups_sha256": TEXT, "link_a": INTS, "link_b": INTS, "times": INTS})


def _looked_up(rows: DataFrame, table: Broadcast, first: bool) -> DataFrame:
    """rows with what the pairs of one table of counts add to n_best and count_sum.

    The first look-up takes all pairs that are not in its table for pairs of one document; a
    table that has them later adds what is missing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        highest, keys, counts = table.value
        for batch in batches:
            for part in stretches(batch, "times", PAIRS_AT_ONCE):
                a, b, times = (part[c].flatten().to_numpy().astype(np.int64) for c in ("link_a", "link_b", "times"))
                key = a << 32 | b
                at = np.searchsorted(keys[:-1], key)
                known = keys[at] == key
                n = np.where(known, counts[at], 1)
                best = np.where(known, n == highest[a], first & (highest[a] == 1))
                ends = np.concatenate(([0], np.cumsum(pc.list_value_length(part["times"]).to_numpy())))
                sums = {}
                for name, added in (("n_best", times * best), ("count_sum", times * (n if first else n - 1))):
                    running = np.concatenate(([0], np.cumsum(added)))
                    sums[name] = pa.array(np.diff(running[ends]) + part[name].to_numpy())
                yield pa.RecordBatch.from_arrays([sums.get(n, part[n]) for n in batch.schema.names], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def link_counts(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, keep: list[str] | None = None) -> DataFrame:
    """The rows of `links` without their pairs, and how usual these are among all docs.

    The count of a pair of ids is the number of rows of docs that hold it linked. n_best is the number of
    links whose count is the highest of their first id, ties included, count_sum the sum over
    all links. Repeated rows count each; an empty table gives no rows.

    Texts are encoded once, and the links stored. Highest counts, a number for each id, are broadcast,
    and so are the pairs of more than one document, PART_PAIRS at a time: more of them take
    further passes over the stored links.
    """
    rows = stored(spark, links(docs, a_path, b_path, keep), "links")
    pair = F.explode(F.arrays_zip("link_a", "link_b")).alias("pair")
    pairs = stored(spark, rows.select(pair).groupBy("pair").agg(F.count("*").alias("n")).select("pair.*", "n"), "pairs")
    top = pairs.groupBy("link_a").agg(F.max("n").alias("n")).toPandas()
    highest = np.zeros(int(top["link_a"].max()) + 1 if len(top) else 1, np.int64)
    highest[top["link_a"].to_numpy(np.int64)] = top["n"]
    many = pairs.where("n > 1")
    parts = max(1, -(-many.count() // PART_PAIRS))
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({"n_best": zero, "count_sum": zero})
    for part in range(parts):
        chosen = many.where(F.pmod(F.xxhash64("link_a", "link_b"), F.lit(parts)) == part)
        chosen = chosen.select((F.shiftleft(F.col("link_a").cast("long"), 32) + F.col("link_b")).alias("key"), "n").toPandas().sort_values("key")
        # No pair has the last key, so that every search ends on some key.
        table = highest, np.append(chosen["key"].to_numpy(np.int64), -1), np.append(chosen["n"].to_numpy(np.int64), 1)
        rows = _looked_up(rows, spark.sparkContext.broadcast(table), first=part == 0)
        if part < parts - 1:
            rows = stored(spark, rows, "looked-up")
    return rows.select("row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
