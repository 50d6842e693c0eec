"""Language-model scores from a Brown class bigram model, clustered by exchange.

Texts are encoded once into blocks of word numbers. What the corpus says about a word, its
count and its neighbours, travels in one packed row for each block and part of the vocabulary,
so the shuffles hold a row for thousands of words. Words are identified by their 64-bit XXH64.
"""

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import map_rows, shuffle_partitions, stored, text_bytes, words
from clickmill.session import new_folder

CLASSES = 64
ROUNDS = 4
SIDE = 256  # groups of neighbours on either side
SMOOTHING = 32.0  # tokens that the prior of a transition or a neighbour counts as
RATIO_BINS = 400  # for the ratio of the two probabilities that are mixed
BLOCK_BYTES = 8_000_000
UNKNOWN = 255
END = b"\n"  # no word holds white space


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, 5), 1)


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.decompress(data))


def _encode(rows: list[tuple], number: int, parts: int) -> dict:
    """One block: its texts as word numbers, and counts and neighbours of its words, by part."""
    numbers = defaultdict()
    numbers.default_factory = numbers.__len__
    of = numbers.__getitem__
    of(END)
    texts = [np.array([*map(of, words(text)), 0], np.int64) for _, _, text in rows]
    lengths = np.array([len(t) for t in texts], np.int32)
    trained = np.repeat([bool(train) for _, train, _ in rows], lengths)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    part = hashes % np.uint64(parts)
    order = np.lexsort((hashes, part))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ids, hashes, part = rank[np.concatenate(texts)], hashes[order], part[order].astype(np.int64)
    counts = np.bincount(ids[trained], minlength=len(hashes))
    side = (hashes >> np.uint64(56)).astype(np.int64)
    before = np.concatenate(([rank[0]], ids[:-1]))
    inner = trained[:-1] & (ids[:-1] != rank[0])
    left = ids[trained] * (2 * SIDE) + side[before[trained]]
    right = ids[:-1][inner] * (2 * SIDE) + SIDE + side[ids[1:][inner]]
    pairs, seen = np.unique(np.concatenate((left, right)), return_counts=True)
    slices = []
    for p in np.unique(part):
        a, b = np.searchsorted(part, [p, p + 1])
        c, d = np.searchsorted(pairs, [a * 2 * SIDE, b * 2 * SIDE])
        slices.append(
            {
                "part": p,
                "hashes": hashes[a:b].tobytes(),
                "seen": pack(counts[a:b].astype(np.uint32), (pairs[c:d] - a * 2 * SIDE).astype(np.uint32), seen[c:d].astype(np.uint32)),
            }
        )
    return {
        "block": [number],
        "doc_ids": [[doc_id for doc_id, _, _ in rows]],
        "train": [[bool(train) for _, train, _ in rows]],
        "lengths": [lengths],
        "ids": [pack((ids & 0xFFFF).astype(np.uint16), (ids >> 16).astype(np.uint16))],
        "end": [int(rank[0])],
        "slices": [slices],
    }


def _blocks(docs: DataFrame, train: Column, parts: int) -> DataFrame:
    slices = "array<struct<part: int, hashes: binary, seen: binary>>"
    types = pa.schema(
        [
            ("block", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("train", pa.list_(pa.bool_())),
            ("lengths", pa.list_(pa.int32())),
            ("ids", pa.binary()),
            ("end", pa.int32()),
            ("slices", pa.list_(pa.struct([("part", pa.int32()), ("hashes", pa.binary()), ("seen", pa.binary())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pydict(_encode(held, number, parts), types)
                    number, held, size = number + 1, [], 0
        if held:
            yield pa.RecordBatch.from_pydict(_encode(held, number, parts), types)

    rows = docs.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), text_bytes().alias("text"))
    schema = "block long, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, end int, "
    return rows.mapInArrow(run, schema + f"slices {slices}")


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """The words of one part of the vocabulary that occur in training, over all blocks."""
    hashes = [np.frombuffer(h, np.uint64) for h in frame["hashes"]]
    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.zeros(len(known), np.int64)
    pairs, seen, start = [], [], 0
    for own, data in zip(hashes, frame["seen"]):
        count, pair, n = unpack(data)
        here = place[start : start + len(own)]
        start += len(own)
        counts[here] += count
        pairs.append(here[pair // (2 * SIDE)] * (2 * SIDE) + pair % (2 * SIDE))
        seen.append(n)
    pairs, place = np.unique(np.concatenate(pairs), return_inverse=True)
    seen = np.bincount(place, np.concatenate(seen), len(pairs)).astype(np.int64)
    kept = counts > 0
    rank = np.cumsum(kept) - 1
    pairs = rank[pairs // (2 * SIDE)] * (2 * SIDE) + pairs % (2 * SIDE)
    return pd.DataFrame(
        {
            "part": [frame["part"].iloc[0]],
            "words": [int(kept.sum())],
            "tokens": [int(counts.sum())],
            "hashes": [known[kept].tobytes()],
            "counts": [counts[kept].tobytes()],
            "neighbours": [pack(pairs // (2 * SIDE), (pairs % (2 * SIDE)).astype(np.int16), seen)],
        }
    )


def _first_classes(hashes: np.ndarray, classes: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(classes)).astype(np.int64)


def _exchanged(size: int, seen: tuple[np.ndarray, ...], profile: np.ndarray) -> np.ndarray:
    """For each word the class whose words have the likeliest neighbours for it, 0 for one that seen lacks.

    seen holds words, in order, their neighbours and how often they met; profile counts the
    neighbours of every class. Words are taken in bounded groups.
    """
    word, side, times = seen
    total = profile.sum(axis=0)
    prior = SMOOTHING * (total + 1) / (total + 1).sum()
    log = np.log((profile + prior) / (profile.sum(axis=1, keepdims=True) + SMOOTHING)).T.astype(np.float32)
    best = np.zeros(size, np.int64)
    for a in range(0, size, 4096):
        c, d = np.searchsorted(word, [a, a + 4096])
        if c == d:
            continue
        own, starts = np.unique(word[c:d], return_index=True)
        gain = np.add.reduceat(log[side[c:d]] * times[c:d, None].astype(np.float32), starts, axis=0)
        best[own] = gain.argmax(axis=1)
    return best


def _half(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(16)) & np.uint64(1)


def _of_half(hashes: np.ndarray, neighbours: bytes, half: int) -> tuple[np.ndarray, ...]:
    word, side, seen = unpack(neighbours)
    use = _half(hashes)[word] == half
    return word[use], side[use], seen[use]


def _profiles(vocabulary: DataFrame, half: int, profile: np.ndarray | None, classes: int) -> np.ndarray:
    """Neighbour counts of the classes, from the words of one half, classed by the other's profile."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for hashes, neighbours in zip(batch["hashes"].to_pylist(), batch["neighbours"].to_pylist()):
            hashes = np.frombuffer(hashes, np.uint64)
            word, side, seen = _of_half(hashes, neighbours, half)
            if profile is None:
                own = _first_classes(hashes, classes)
            else:
                own = _exchanged(len(hashes), (word, side, seen), profile)
            sums = np.bincount(own[word] * (2 * SIDE) + side, seen, classes * 2 * SIDE)
            cell = np.flatnonzero(sums)
            yield {"cell": cell.astype(np.int32), "n": sums[cell].astype(np.int64)}

    sums = map_rows(vocabulary.select("hashes", "neighbours"), count, "cell int, n long")
    found = sums.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(classes * 2 * SIDE)
    total[found["cell"].to_numpy(int)] = found["n"]
    return total.reshape(classes, 2 * SIDE)


def cluster(vocabulary: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """part, hashes, classes, counts: exchange clustering of the whole vocabulary.

    Words start in classes by hash. Each round moves the words of one half, all at once, to
    the class whose neighbour counts, taken from the other half, make theirs likeliest, then
    the other half likewise: no word is compared with a class it counts in itself. Neighbours
    are told apart in 256 groups on either side. Only the counts of classes, a table of fixed
    size, come to the driver.
    """
    odd = _profiles(vocabulary, 1, None, classes)
    for _ in range(rounds):
        even = _profiles(vocabulary, 0, odd, classes)
        odd = _profiles(vocabulary, 1, even, classes)

    def assign(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in batch.to_pylist():
            hashes = np.frombuffer(row["hashes"], np.uint64)
            halves = [_of_half(hashes, row["neighbours"], half) for half in (0, 1)]
            by_odd, by_even = (_exchanged(len(hashes), seen, p) for seen, p in zip(halves, (odd, even)))
            own = np.where(_half(hashes) == 0, by_odd, by_even).astype(np.uint8)
            yield {"part": [row["part"]], "hashes": [row["hashes"]], "classes": [own.tobytes()], "counts": [row["counts"]]}

    wanted = vocabulary.select("part", "hashes", "counts", "neighbours")
    return map_rows(wanted, assign, "part int, hashes binary, classes binary, counts binary")


def _look_up(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Class and count of each word that the blocks ask of one part; class UNKNOWN, count 0 if it has none."""
    hashes, classes, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    if len(known):
        row = known.iloc[0]
        hashes, classes, counts = (np.frombuffer(row[c], t) for c, t in (("hashes", np.uint64), ("classes", np.uint8), ("counts", np.int64)))
    answers = []
    for wanted in asked["hashes"]:
        wanted = np.frombuffer(wanted, np.uint64)
        if not len(hashes):
            answers.append(pack(np.full(len(wanted), UNKNOWN, np.uint8), np.zeros(len(wanted), np.int64)))
            continue
        place = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        found = hashes[place] == wanted
        answers.append(pack(np.where(found, classes[place], UNKNOWN).astype(np.uint8), np.where(found, counts[place], 0)))
    return pd.DataFrame({"block": asked["block"], "part": asked["part"], "answer": answers})


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, previous class and count of every token of a block."""
    answers = [unpack(x["answer"]) for x in sorted(row["answers"], key=lambda x: x["part"])]
    classes, counts = (np.concatenate(x) for x in zip(*answers))
    low, high = unpack(row["ids"])
    ids = low.astype(np.int64) | high.astype(np.int64) << 16
    own = classes[ids]
    return own, np.concatenate(([classes[row["end"]]], own[:-1])), counts[ids]


def _base_weight(cells: np.ndarray, n: np.ndarray) -> float:
    """The likeliest weight of the base model for tokens in bins of the ratio of class to base probability.

    Bin 0 is of tokens that the class model does not know. Found by expectation maximisation.
    """
    if not n.sum():
        return 1.0
    ratio = np.where(cells == 0, 0.0, 2.0 ** ((cells - 1 - RATIO_BINS // 2) / 10))
    weight = 0.5
    for _ in range(200):
        weight = float((n * weight / (weight + (1 - weight) * ratio)).sum() / n.sum())
    return min(max(weight, 1e-6), 1.0)


def score(
    spark: SparkSession,
    docs: DataFrame,
    train: Column,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Log10 probability of every text of docs (doc_id, text) under a class bigram model.

    The model learns from the rows where `train` holds. A token w after v, with classes d and
    c, has probability

        (1 - b) p(d|c) n(w)/n(d) + b (n(w)+1)/(N+V+1)

    p(d|c) is the share of transitions, smoothed by the share of d in all tokens. The weight b
    is the likeliest one for the training tokens, each left out of its counts. A word that
    training lacks has no class; what follows it is judged by the share of its class alone.
    Without any training token only the second term counts, with weight 1. A text ends with a
    token of its own, which also stands before its first word.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score (the second term alone, weight
    1), score and perplexity, a row for each row of docs. A null or empty text is the end token
    alone. A null doc_id stays null, and a null `train` is false.
    """
    blocks = _store_blocks(spark, _blocks(docs, train, shuffle_partitions(spark)))
    slices = blocks.select("block", F.explode("slices").alias("s"))
    packed = slices.select("s.part", "s.hashes", "s.seen")
    vocabulary = packed.groupBy("part").applyInPandas(
        _merge, "part int, words long, tokens long, hashes binary, counts binary, neighbours binary"
    )
    vocabulary = stored(spark, vocabulary, "vocabulary")
    size = vocabulary.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    tokens, distinct = size["tokens"] or 0, size["words"] or 0
    classed = stored(spark, cluster(vocabulary, classes, rounds), "classes")
    asked = slices.select("block", "s.part", "s.hashes").groupBy("part")
    answers = asked.cogroup(classed.groupBy("part")).applyInPandas(_look_up, "block long, part int, answer binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    answers = stored(spark, answers, "answers")

    def transitions(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in batch.to_pylist():
            own, before, _ = _tokens(row)
            trained = np.repeat(row["train"], row["lengths"])
            sums = np.bincount(before[trained].astype(int) * classes + own[trained], minlength=classes**2)
            cell = np.flatnonzero(sums)
            yield {"cell": cell.astype(np.int32), "n": sums[cell]}

    with_classes = blocks.select("block", "train", "lengths", "ids", "end").join(answers, "block").drop("block")
    found = map_rows(with_classes, transitions, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(classes**2)
    counts[found["cell"].to_numpy(int)] = found["n"]
    counts = counts.reshape(classes, classes)
    in_class, total = counts.sum(axis=0), max(1, tokens)
    share = np.zeros((UNKNOWN + 1, classes))
    share[:classes] = (counts + SMOOTHING * in_class / total) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
    share[UNKNOWN] = in_class / total

    def ratios(batch: pa.RecordBatch) -> Iterator[dict]:
        """How often each ratio of class to base probability occurs, in steps of a tenth of a power of two."""
        for row in batch.to_pylist():
            own, before, count = _tokens(row)
            trained = np.repeat(row["train"], row["lengths"])
            own, before, count = own[trained], before[trained], count[trained]
            again = count > 1
            own, before, count = own[again], before[again], count[again]
            model = share[before, own] * (count - 1) / (in_class[own] - 1)
            step = np.log2(model * (tokens + distinct) / count) * 10
            bins = np.bincount(np.clip(np.rint(step) + RATIO_BINS // 2, 0, RATIO_BINS).astype(int) + 1, minlength=RATIO_BINS + 2)
            bins[0] = len(again) - again.sum()
            cell = np.flatnonzero(bins)
            yield {"cell": cell.astype(np.int32), "n": bins[cell]}

    found = map_rows(with_classes, ratios, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    base_weight = _base_weight(found["cell"].to_numpy(int), found["n"].to_numpy(float))

    def rate(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in batch.to_pylist():
            own, before, count = _tokens(row)
            known = own != UNKNOWN
            base = (count + 1) / (tokens + distinct + 1)
            p = base_weight * base
            p[known] += (1 - base_weight) * share[before[known], own[known]] * count[known] / in_class[own[known]]
            starts = np.cumsum(row["lengths"]) - row["lengths"]
            base_score, model = (np.add.reduceat(np.log10(x), starts) for x in (base, p))
            yield {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "n_tokens": np.array(row["lengths"], np.int64),
                "n_known": np.add.reduceat(known.astype(np.int64), starts),
                "train_tokens": np.full(len(starts), tokens),
                "base_score": base_score,
                "score": model,
                "perplexity": 10.0 ** np.minimum(300, -model / row["lengths"]),
            }

    return map_rows(
        blocks.select("block", "doc_ids", "lengths", "ids", "end").join(answers, "block").drop("block"),
        rate,
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
    )


def _store_blocks(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """The blocks as a table bucketed by number, so that joins on it leave them where they are."""
    path = new_folder(spark, "blocks")
    name = f"blocks_{path[-12:]}"
    buckets = shuffle_partitions(spark)
    blocks.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return spark.table(name)
