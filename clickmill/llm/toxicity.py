"""Toxicity by classifier chains."""

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import arrow_rows, release_memory, stored
from clickmill.llm.training import SAMPLE, Sparse, fit_sparse, labelled_sample, logit, sigmoid

FEATURES = 2_000
LEAST = 2  # sample documents that a feature must occur in
SURPRISE = 3.0  # standard deviations by which its toxic documents must differ from the usual share
STEMS = (4, 5)  # letters of word beginnings
FOLDS = 3
REMEMBERED = 300_000  # words whose features a task keeps
COUNTED = 100_000  # features that a task counts before it passes the counts on
SEED = 5
OVERALL = "toxic"
WORD = re.compile(r"\w+")


def features(word: str) -> list[tuple[int, str]]:
    """A word and its beginnings, each with its kind: 0 for the word, then one for each length in STEMS."""
    return [(0, word), *((kind, word[:n]) for kind, n in enumerate(STEMS, 1) if len(word) > n)]


def words_of(text: str) -> set[str]:
    """The distinct words of a text, in lower case."""
    return set(WORD.findall(text.lower()))


class Remembered(dict):
    """For a word the numbers of its features; a task works them out once for each of its words."""

    def __init__(self, numbers: list[dict[str, int]]):
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = tuple(self.numbers[kind][f] for kind, f in features(word) if f in self.numbers[kind])
        return found


@dataclass
class Chain:
    """Linear models in order; each also weighs the probabilities of those before it."""

    categories: list[str]
    numbers: list[dict[str, int]]  # of each kind of feature
    words: list[np.ndarray]
    earlier: list[np.ndarray]
    constants: list[float]
    threshold: float = 0.5  # of the last category's probability

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "remembered"}

    def found(self, text: str) -> np.ndarray:
        """Numbers of the features that a text has."""
        if "remembered" not in vars(self):
            self.remembered = Remembered(self.numbers)
        own = set().union(*filter(None, map(self.remembered.__getitem__, words_of(text))))
        return np.fromiter(own, int, len(own))

    def probabilities(self, text: str) -> list[float]:
        own, so_far = self.found(text), []
        for words, earlier, constant in zip(self.words, self.earlier, self.constants):
            so_far.append(float(sigmoid(words[own].sum() + earlier @ np.array(so_far) + constant)))
        return so_far


def best_threshold(probability: np.ndarray, label: np.ndarray) -> float:
    """The threshold of fewest errors.

    Of several, the lower quarter of the widest gap in log odds between probabilities, as
    toxic words that the sample lacks score low.
    """
    order = np.argsort(probability, kind="stable")
    odds = logit(np.clip(probability[order], 1e-12, 1 - 1e-12))
    missed = np.cumsum(label[order])
    wrong = np.cumsum(1 - label[order][::-1])[::-1]
    # Between the sorted probabilities i and i + 1.
    errors, gap = missed[:-1] + wrong[1:], np.diff(odds)
    best = np.lexsort((-gap, errors + len(label) * (gap <= 0)))[0]
    return float(sigmoid(odds[best] + (odds[best + 1] - odds[best]) / 4))


def _select(sample: DataFrame, categories: Sequence[str]) -> list[dict[str, int]]:
    """The features whose presence says most about whether any category applies, FEATURES at most."""
    any_category = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in categories], F.lit(0))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, positive = Counter(), Counter()

        def counted() -> pd.DataFrame:
            found = pd.DataFrame([(k, f, n, positive[k, f]) for (k, f), n in rows.items()], columns=["kind", "feature", "n", "p"])
            rows.clear()
            positive.clear()
            return found

        for frame in frames:
            for text, label in zip(frame["text"], frame["label"]):
                own = {f for word in words_of(text) for f in features(word)}
                rows.update(own)
                if label:
                    positive.update(own)
                if len(rows) > COUNTED:
                    yield counted()
        yield counted()
        release_memory()

    texts = sample.select(F.coalesce("text", F.lit("")).alias("text"), any_category.alias("label"))
    total = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("p")).first()
    counts = texts.mapInPandas(count, "kind int, feature string, n long, p long").groupBy("kind", "feature")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("p").alias("p")).where(F.col("n") >= LEAST)
    expected = total["p"] / max(1, total["n"])
    surprise = F.abs(F.col("p") - F.col("n") * expected) / F.sqrt(F.col("n") * max(expected * (1 - expected), 1e-9))
    best = counts.where(surprise >= SURPRISE).orderBy(surprise.desc(), "kind", "feature").limit(FEATURES).collect()
    numbers: list[dict[str, int]] = [{} for _ in range(1 + len(STEMS))]
    for i, row in enumerate(best):
        numbers[row["kind"]][row["feature"]] = i
    return numbers


def fit(spark: SparkSession, sample: DataFrame, categories: Sequence[str]) -> Chain:
    """Fit a chain on sample (doc_id, text and a 0/1 column for each category, null as 0).

    Each model learns from the features and from the probabilities that earlier categories
    got out of fold: from models that did not see the document. The threshold of the last
    category is set on the same predictions. Without examples the chain finds nothing toxic.
    """
    sample = stored(spark, sample.select("doc_id", "text", *categories), "toxic-sample")
    chain = Chain(list(categories), _select(sample, categories), [], [], [])
    empty = Chain([], chain.numbers, [], [], [])

    @F.pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: empty.found(text).astype(np.int32))

    rows = sample.select("doc_id", *categories, found(F.coalesce("text", F.lit(""))).alias("found"))
    rows = rows.orderBy("doc_id").toPandas()
    x = Sparse([np.array(f, int) for f in rows["found"]], max(1, sum(map(len, chain.numbers))))
    fold = np.random.default_rng(SEED).permutation(len(rows)) % FOLDS
    earlier = np.zeros((len(rows), 0))
    for category in categories:
        label = rows[category].fillna(0).to_numpy(float)
        if label.sum() == 0:
            weights = np.zeros(x.width), np.zeros(earlier.shape[1]), -40.0
            apart = np.zeros(len(rows))
        else:
            apart = np.empty(len(rows))
            for f in range(FOLDS):
                words, before, constant = fit_sparse(x, earlier, label, (fold != f).astype(float))
                apart[fold == f] = sigmoid(x.times(words) + earlier @ before + constant)[fold == f]
            weights = fit_sparse(x, earlier, label, np.ones(len(rows)))
        chain.words.append(weights[0])
        chain.earlier.append(weights[1])
        chain.constants.append(weights[2])
        earlier = np.column_stack([earlier, apart])
    if 0 < label.sum() < len(label):
        chain.threshold = best_threshold(apart, label)
    return chain


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Chain:
    """A chain over toxicity in each language of docs (doc_id, text, lang), then overall.

    labels has doc_id and toxic (0/1). About `bound` labelled documents are learnt from. The
    category of a language is what is toxic in its documents; the languages are those that
    more than a hundredth of the sample's toxic documents have, the most frequent first.
    """
    labels = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = labelled_sample(docs.select("doc_id", "text", "lang"), labels, bound, SEED)
    sample = stored(spark, sample.withColumnRenamed("toxic", OVERALL), "toxic-labels")
    found = sample.where(F.col(OVERALL) == 1).groupBy("lang").agg(F.count("*").alias("n"))
    found = found.orderBy(F.desc("n"), "lang").limit(100).collect()
    total = sum(row["n"] for row in found)
    langs = [row["lang"] for row in found if row["lang"] is not None and row["n"] * 100 > total]
    named = {f"{OVERALL}_{i}": F.when(F.col("lang") == lang, F.col(OVERALL)).otherwise(0) for i, lang in enumerate(langs)}
    chain = fit(spark, sample.withColumns(named) if named else sample, [*named, OVERALL])
    chain.categories = [*(f"{OVERALL}_{lang}" for lang in langs), OVERALL]
    return chain


def probabilities(chain: Chain, text: Column) -> Column:
    """Probability of every category of the chain; a null text is empty."""

    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(chain.probabilities)
        vars(chain).pop("remembered", None)
        release_memory()

    return of(F.coalesce(text, F.lit("")))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, categories (a map from category to probability), probability, toxic, for every row of docs.

    toxic says whether the overall probability, the last of the chain, reaches its threshold.
    Whole texts count. A null or empty text has no features and the probabilities of that;
    repeated rows give repeated results; a null doc_id stays null.
    """
    with arrow_rows(spark):
        chain = learn(spark, docs, labels, bound)
        rows = stored(spark, docs.select("doc_id", probabilities(chain, F.col("text")).alias("p")), "toxic-found")
    names = F.array(*[F.lit(c) for c in chain.categories])
    last = F.element_at("p", -1)
    return rows.select("doc_id", F.map_from_arrays(names, "p").alias("categories"), last.alias("probability"), (last >= chain.threshold).alias("toxic"))


def clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    with arrow_rows(spark):
        chain = learn(spark, docs, labels, bound)
        return stored(spark, docs.where(F.element_at(probabilities(chain, F.col("text")), -1) < chain.threshold), "clean")
