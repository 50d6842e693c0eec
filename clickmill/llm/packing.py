"""Best-fit packing of tokenised documents by minimum bin slack."""

import os
import string
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import arrow_rows, release_memory, stored, stretches, text_bytes
from clickmill.llm.prefix import pieces_of, with_running_total

CAPACITY = 4096
END_ID = 1
CACHED = 250_000  # words whose ids a task remembers from one stretch of text to the next
MARKS = string.punctuation.replace("'", "").encode()
LONGEST = 64  # bytes of such a word
AT_ONCE = 1_000_000  # bytes of text, unless one text alone is longer
ROWS_AT_ONCE = 500  # passed to Python

# How byte-level vocabularies write bytes: printable ones as themselves, the others, in order, from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {byte: 256 + i for i, byte in enumerate(sorted(set(range(256)) - set(SHOWN)))}


class WordIds:
    """Ids of texts, from the remembered ids of their words.

    The tokenizer never joins what white space parts, so runs of other characters are
    tokenised alone. Nor does it join a letter with the marks after it, all of which at the end of a
    run are one piece. What is letters only, in lower case, is one piece to its last step, which is then called directly.
    Of more than CACHED words only the half that came most often is kept, and none of over
    LONGEST bytes, so what is remembered takes some megabytes however many words there are.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.merge = self.tokenizer.model.tokenize
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        # The ids of all runs, one after the other, and by their numbers how many each has, where
        # they start and how often the run was seen.
        self.flat = np.zeros(0, "<u4")
        self.count, self.first, self.seen = (np.zeros(0, np.int64) for _ in range(3))

    def forget(self) -> None:
        """Keep the words seen most often, and count half of what they were seen."""
        runs = list(self.numbers)
        long = np.fromiter(map(len, runs), np.int64, len(runs)) > LONGEST
        kept = np.argsort(np.where(long, 0, -self.seen), kind="stable")[: CACHED // 2]
        kept = np.sort(kept[~long[kept]])
        self.numbers.clear()
        for i in kept.tolist():
            self.numbers[runs[i]]
        self.flat = self._ids(kept)
        self.count, self.seen = self.count[kept], self.seen[kept] // 2
        self.first = np.cumsum(self.count) - self.count

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of runs, one after the other."""
        count = self.count[numbers]
        end = np.cumsum(count)
        return self.flat[np.repeat(self.first[numbers] - end + count, count) + np.arange(end[-1] if len(end) else 0)]

    def learn(self) -> None:
        """Tokenise the runs that have numbers but no ids yet."""
        of, known, merge = self.numbers.__getitem__, len(self.count), self.merge
        plain, others, marked, parts = [], [], [], []
        for run in list(islice(self.numbers, known, None)):
            if _only_letters(run):
                plain.append(run)
                continue
            stem = run.rstrip(MARKS)
            if len(stem) < len(run) and _only_letters(stem):
                marked.append(run)
                parts += stem, run[len(stem) :]
            else:
                others.append(run)
        asked = len(self.numbers)
        both = np.fromiter(map(of, parts), np.int64, len(parts)).reshape(-1, 2)
        for run in list(islice(self.numbers, asked, None)):
            (others if run[0] in MARKS else plain).append(run)
        shown = [run.decode() if run.isascii() else run.decode("latin-1").translate(BYTE_LEVEL) for run in plain]
        pieces = list(map(merge, shown))
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([run.decode(errors="replace") for run in others], add_special_tokens=False)]
        lengths = np.fromiter(map(len, chain(pieces, rest)), np.int64, len(pieces) + len(rest))
        numbers = np.array(list(map(of, plain + others)), np.int64)
        self.count, self.first, self.seen = (np.concatenate([c, np.zeros(len(self.numbers) - known, np.int64)]) for c in (self.count, self.first, self.seen))
        self.count[numbers] = lengths
        self.first[numbers] = len(self.flat) + np.cumsum(lengths) - lengths
        ids = chain(map(attrgetter("id"), chain.from_iterable(pieces)), chain.from_iterable(rest))
        self.flat = np.concatenate([self.flat, np.fromiter(ids, "<u4", lengths.sum())])
        if marked:
            numbers = np.array(list(map(of, marked)), np.int64)
            self.count[numbers] = lengths = self.count[both].sum(axis=1)
            self.first[numbers] = len(self.flat) + np.cumsum(lengths) - lengths
            self.flat = np.concatenate([self.flat, self._ids(both.ravel())])

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each."""
        if len(self.numbers) > CACHED:
            self.forget()
        runs = [_lowered(text).split() for text in texts]
        lengths = [len(r) for r in runs]
        number = self.numbers.__getitem__
        words = np.fromiter(chain.from_iterable(map(number, text) for text in runs), np.int32, sum(lengths))
        if len(self.numbers) > len(self.count):
            self.learn()
        self.seen += np.bincount(words, minlength=len(self.seen))
        end = np.cumsum(self.count[words])
        edges = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(lengths)))]
        return self._ids(words), np.diff(edges)


def _lowered(text: bytes) -> bytes:
    """The text with A-Z in lower case, unless it has an accent (U+0300 to U+036F) that one of them might join, or "<|".

    With that begin special tokens, which are such in lower case only.
    """
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


def _only_letters(run: bytes) -> bool:
    """Whether a run is of letters, in lower case, that normalising leaves as they are."""
    if run.isascii():
        return run.isalpha() and run.islower()
    text = run.decode(errors="replace")
    return text.isalpha() and text.lower() == text and unicodedata.is_normalized("NFC", text)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and then end_id, cut after each `capacity`.

    A null or empty text has the one id end_id.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(doc_ids: list, texts: list[bytes], words: WordIds) -> pa.RecordBatch:
        rows = []
        ids, lengths = words.of(texts)
        for doc_id, part in zip(doc_ids, np.split(ids, np.cumsum(lengths)[:-1])):
            data = part.tobytes() + end
            for piece, start in enumerate(range(0, len(data), width)):
                one = data[start : start + width]
                rows.append((doc_id, piece, start // 4, len(one) // 4, zlib.crc32(one)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        words = WordIds(tokenizer_path)
        for batch in batches:
            for part in stretches(batch, "text", AT_ONCE):
                yield cut(part["doc_id"].to_pylist(), part["text"].to_pylist(), words)
        del words
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], space: int) -> list[int]:
    """Lengths, none more often than counted, with the largest sum that `space` holds.

    Bit s of a set of sums is 1 if some choice of the lengths so far has the sum s. Longer
    lengths come first, and the search ends once the space can be filled.
    """
    reach, steps = 1, []
    limit = (1 << (space + 1)) - 1
    for length in sorted((x for x in counts if x <= space and counts[x]), reverse=True):
        left, take = min(counts[length], space // length), 1
        while left:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & limit
            left -= take
            take *= 2
        if reach >> space & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as lists of lengths, each with the number of times it is used; every length is used up.

    Minimum bin slack: the longest length left opens a bin, and of all combinations of the
    others the one that fills it best joins it. The same combination stays the best until one
    of its lengths runs out, so it is taken that many times; there are about as many
    different bins as lengths, however many documents.
    """
    left = {length: n for length, n in counts.items() if n}
    bins = []
    while left:
        first = max(left)
        left[first] -= 1
        chosen = [first, *fullest(left, capacity - first)]
        left[first] += 1
        need = {length: chosen.count(length) for length in set(chosen)}
        times = min(left[length] // n for length, n in need.items())
        bins.append((chosen, times))
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return bins


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pack docs (doc_id, text) into as few sequences of `capacity` ids as minimum bin slack finds.

    Returns the rows of `pieces` with sequence_id and offset, the place in the sequence,
    gapless from 0. Every row of docs is packed on its own, repeated ones and ones without a
    doc_id too. Only the number of pieces of each length, at most `capacity` numbers, comes to
    the driver; the pieces of a length take its places in the order of a digest of their ids.
    """
    with arrow_rows(spark, ROWS_AT_ONCE):
        cut = stored(spark, pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    counts = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, entries, sequence = [], [], 0
    ranks = dict.fromkeys(counts, 0)
    for chosen, times in patterns(counts, capacity):
        starts: dict[int, list[int]] = {}
        offset = 0
        for length in chosen:
            starts.setdefault(length, []).append(offset)
            offset += length
        for length, places in starts.items():
            keys.append((length, ranks[length]))
            entries.append((sequence, places))
            ranks[length] += times * len(places)
        sequence += times
    order = sorted(range(len(keys)), key=keys.__getitem__)
    lengths = np.array([keys[i][0] for i in order], np.int64)
    bases = np.array([keys[i][1] for i in order], np.int64)
    firsts = np.array([entries[i][0] for i in order], np.int64)
    width = np.array([len(entries[i][1]) for i in order], np.int64)
    places = np.array([p for i in order for p in entries[i][1]], np.int64)
    place_at = np.cumsum(width) - width
    edges = np.searchsorted(lengths, np.arange(capacity + 2))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        entry = np.empty(len(length), np.int64)
        for one in np.unique(length):
            a, b = edges[one], edges[one + 1]
            here = length == one
            entry[here] = a + np.searchsorted(bases[a:b], rank[here], "right") - 1
        turn = rank - bases[entry]
        return pd.DataFrame({"sequence_id": firsts[entry] + turn // width[entry], "offset": places[place_at[entry] + turn % width[entry]]})

    digest = F.md5(F.concat_ws(",", "doc_id", "piece"))
    tie = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32"), F.col("start")]
    ranked = with_running_total(cut, F.col("length"), digest, F.lit(1), pieces_of(sum(counts.values())), tie, "rank")
    return ranked.withColumn("at", place("length", "rank")).select(*cut.columns, "at.*")
