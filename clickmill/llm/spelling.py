"""Spelling variants: words one letter apart, found by PartEnum signatures of their letters."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import stored, stretches, text_bytes

RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # a-z and U+00C0 to U+00FF in UTF-8, after A-Z are in lower case
SLIPS = 97  # one occurrence in so many loses a letter
LEAST_LENGTH, LEAST_COUNT = 5, 3
PARTS = 6  # of the letters
AT_ONCE = 4_000_000  # bytes of text
HELD = 100_000  # words whose counts a task holds before it passes them on


def runs(doc_id: int | None, text: bytes) -> list[bytes]:
    """The runs of letters of a text, some of them a letter short as a hash of document and run has it."""
    found = RUN.findall(text.lower())
    prefix = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    prefix = zlib.crc32(b":", prefix)
    hashes = np.array([zlib.crc32(run, prefix) for run in found], np.int64)
    for i in np.flatnonzero(hashes % SLIPS == 0).tolist():
        run = found[i].decode()
        at = int(hashes[i]) % len(run)
        found[i] = (run[:at] + run[at + 1 :]).encode()
    return found


def word_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, n: the runs of docs (doc_id, text) of LEAST_LENGTH letters or more that occur LEAST_COUNT times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            found = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return found

        for batch in batches:
            for part in stretches(batch, "text", AT_ONCE):
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    counts.update(runs(doc_id, text))
                    if len(counts) > HELD:
                        yield passed_on()
        yield passed_on()

    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    found = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


def letter_parts(words: DataFrame, parts: int = PARTS) -> dict[str, int]:
    """A part for each letter, so that all parts hold about equally many letters of the words.

    There are at most 90 letters, so their numbers come to the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count().collect()
    load, part_of = [0] * parts, {}
    for letter, n in sorted(((r["letter"], r["count"]) for r in letters), key=lambda x: (-x[1], x[0])):
        part_of[letter] = load.index(min(load))
        load[part_of[letter]] += n
    return part_of


def _mixed(value: np.ndarray, seed: int) -> np.ndarray:
    """A hash of 64 bits."""
    x = (value + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def part_sums(words: list[str], part_of: dict[str, int], parts: int) -> np.ndarray:
    """A row for each word, and for each part a sum of random numbers that tells the letters in it.

    A word is the set of its letters with their turns: the second e of a word is an element of
    its own, and lies in the part after that of the first.
    """
    length = np.array([len(w) for w in words], np.int64)
    letters = sorted(part_of)
    number = {letter: i for i, letter in enumerate(letters)}
    part = np.array([part_of[letter] for letter in letters], np.int64)
    letter = np.fromiter((number[c] for w in words for c in w), np.int64, length.sum())
    word = np.repeat(np.arange(len(words)), length)
    order = np.lexsort((letter, word))
    word, letter = word[order], letter[order]
    fresh = np.flatnonzero(np.diff(word * len(letters) + letter, prepend=-1))
    turn = np.arange(len(word)) - np.repeat(fresh, np.diff(fresh, append=len(word)))
    sums = np.zeros((len(words), parts), np.uint64)
    np.add.at(sums, (word, (part[letter] + turn) % parts), _mixed((letter + turn * len(letters)).astype(np.uint64), 0))
    return sums


def _signed(words: DataFrame, part_of: dict[str, int], parts: int, describe, columns: list[str]) -> DataFrame:
    """word, n, and describe(sums, length) as further columns, an array of a row for each word and a column for each signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["word"].to_pylist()
            if not found:
                continue
            length = np.array([len(w) for w in found], np.uint64)
            made = describe(part_sums(found, part_of, parts), length)
            of = pa.array(np.repeat(np.arange(len(found)), made[0].shape[1]))
            arrays = [batch["word"].take(of), batch["n"].take(of), *(pa.array(m.ravel()) for m in made)]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n", *columns])

    return words.select("word", "n").mapInArrow(run, ", ".join(["word string, n long", *(f"{c} long" for c in columns)]))


def replaced(words: DataFrame, part_of: dict[str, int], parts: int) -> DataFrame:
    """Pairs of words of one length that differ in one letter: word, n, other, other_n, each pair once.

    Replacing a letter takes one element out of a word's set and puts another in, so the sets
    are at distance two, and all but two parts of them are equal. There is a signature for
    each two parts, of the others and of the length; words with an equal one are compared.
    Where the difference lies in two parts, only the signature without these is equal. Where
    it lies in one, several are, and the one that leaves out the next part too is taken. Words of the
    same letters in another order are no such pair.
    """
    left_out = list(combinations(range(parts), 2))
    first, second = (np.array(side) for side in zip(*left_out))
    which = np.uint64(1 << len(left_out).bit_length())

    def describe(sums, length):
        rest = sums.sum(axis=1)[:, None] - sums[:, first] - sums[:, second]
        # The last bits of a signature say which one of a word's it is.
        signature = [_mixed(rest[:, i] * np.uint64(3) + length, 1) // which * which + np.uint64(i) for i in range(len(left_out))]
        return np.column_stack(signature).view(np.int64), sums[:, first].view(np.int64), sums[:, second].view(np.int64)

    signed = _signed(words, part_of, parts, describe, ["signature", "first", "second"])
    a, b = signed.alias("a"), signed.alias("b")
    number = F.pmod(F.col("a.signature"), F.lit(int(which)))
    first_differs, second_differs = F.col("a.first") != F.col("b.first"), F.col("a.second") != F.col("b.second")
    next_part = number.isin([i for i, (p, q) in enumerate(left_out) if q == p + 1])
    # After the last part comes the first.
    next_first = number == left_out.index((0, parts - 1))
    once = F.when(first_differs, second_differs | next_part).otherwise(second_differs & next_first)
    return _near(a, b, once & (F.col("a.word") < F.col("b.word")))


def inserted(words: DataFrame, part_of: dict[str, int], parts: int) -> DataFrame:
    """Pairs of words of which the second has one letter more: word, n, other, other_n, each pair once.

    The longer word's set has one element more, so all parts but one are equal: one signature
    for each part, of the others and of the longer word's length, and only one of them is equal.
    """
    def describe(sums, length, more):
        rest = sums.sum(axis=1)[:, None] - sums
        return (np.column_stack([_mixed(rest[:, i] * np.uint64(3) + length + np.uint64(more), i + 1) for i in range(parts)]).view(np.int64),)

    a = _signed(words, part_of, parts, lambda sums, length: describe(sums, length, 1), ["signature"]).alias("a")
    b = _signed(words, part_of, parts, lambda sums, length: describe(sums, length, 0), ["signature"]).alias("b")
    return _near(a, b, F.lit(True))


def _near(a: DataFrame, b: DataFrame, condition: Column) -> DataFrame:
    """Words of equal signatures that are verified to be one letter apart; the join compares and returns no others."""
    verified = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    joined = a.join(b, (F.col("a.signature") == F.col("b.signature")) & condition & verified)
    return joined.select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word, root for forms (word, form): the last form that the word's leads to.

    A form occurs at least twice as often as its word, so there are no circles and no more
    than 62 steps; every round doubles those taken.
    """
    reached = stored(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = reached.join(further, F.col("root") == F.col("_word"), "left")
        moved = F.col("_root").isNotNull().alias("moved")
        reached = stored(spark, joined.select("word", F.coalesce("_root", "root").alias("root"), moved), "roots")
        if reached.where("moved").isEmpty():
            return reached.drop("moved")


def variants(spark: SparkSession, docs: DataFrame, parts: int = PARTS) -> DataFrame:
    """Words of docs (doc_id, text) that are spelled almost like others.

    A run is as many of A-Z, a-z and U+00C0 to U+00FF as follow each other, with A-Z in lower
    case; where SLIPS divides the CRC-32 of `<doc_id>:<run>` (a null id is empty), the letter at the
    remainder of that by the run's length is left out. Words are the runs of at least LEAST_LENGTH
    letters that occur at least LEAST_COUNT times (n). Two are near if one letter inserted, deleted or
    replaced makes one of the other. A word's form is the near word of the largest n, the first in
    code-point order among equals, if it occurs at least twice as often; its root is the last one when forms
    are followed from it, the word itself without a form.

    Returns word, form, root, n, n_near, form_n for every word. Null and empty texts have none, repeated rows
    count each, an empty table gives no rows.
    """
    words = stored(spark, word_counts(spark, docs), "words")
    part_of = letter_parts(words, parts)
    near = replaced(words, part_of, parts).unionByName(inserted(words, part_of, parts))
    there, back = F.struct("word", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = near.select(F.explode(F.array(there, back)).alias("near")).select("near.*")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    found = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(found, "word", "left")
    usual = -F.col("best.n") >= 2 * F.col("n")
    found = found.select(
        "word", F.when(usual, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(usual, -F.col("best.n")).alias("form_n"),
    )
    found = stored(spark, found, "forms")
    roots = _roots(spark, found.where("form is not null"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
