"""Document quality by hierarchical empirical Bayes over hosts and paths."""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import arrow_rows, keyed_rows, stored, text_bytes
from clickmill.llm.training import SAMPLE, fit_dense, labelled_sample, logit, sigmoid

THRESHOLD = 0.5
SEED = 1
SPREAD = 6.0  # largest part that one document's evidence has, in log odds
LETTER, UPPER, DIGIT, MARK, SYMBOL, SPACE, HIGH = range(7)
KIND = np.full(256, SYMBOL)
KIND[[*range(97, 123)]], KIND[[*range(65, 91)]], KIND[[*range(48, 58)]] = LETTER, UPPER, DIGIT
KIND[[*b".,;:'-\"?()"]], KIND[[*b" \t\n\v\f\r"]], KIND[128:] = MARK, SPACE, HIGH


def describe(text: bytes) -> list[float]:
    """What a text looks like: kinds of characters, length and repetition of its words and lines."""
    kinds = np.bincount(KIND[np.frombuffer(text, np.uint8)], minlength=7) / max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    lines = text.split(b"\n")
    bare = sum(not word.isalnum() and word.isascii() and word[-1] not in b".,;:?)'\"" for word in counts) / max(1, len(counts))
    return [
        *kinds,
        np.log1p(len(words)),
        len(text) / n,
        np.log1p(len(counts)) / np.log1p(n) if words else 0.0,
        max(counts.values(), default=0) / n,
        same / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(lines)) / np.log1p(n) if words else 0.0,
        bare,
        float(not words),
    ]


class Classifier:
    """A logistic model on the features and their squares."""

    def __init__(self, features: np.ndarray, label: np.ndarray):
        self.mean = features.mean(axis=0) if len(features) else np.zeros(1)
        self.scale = features.std(axis=0) + 1e-9 if len(features) else np.ones(1)
        self.rate = (label.sum() + 1) / (len(label) + 2)
        self.weights = fit_dense(self.expand(features), label) if len(features) else None

    def expand(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -6, 6)
        return np.column_stack([x, x**2])

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.rate)
        x = self.expand(features)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Classifier:
    """Fit the document classifier on about `bound` labelled documents (labels: doc_id, quality)."""
    labels = labels.where("quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    sample = labelled_sample(docs.select("doc_id", "text"), labels, bound, SEED)

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(describe)

    rows = sample.select("doc_id", "quality", of(text_bytes()).alias("x")).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(describe(b"")))
    return Classifier(x, rows["quality"].to_numpy(float))


def evidence(classifier: Classifier, text: Column) -> Column:
    """The classifier's probability of good quality; a null text is empty."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(classifier.probability(np.array([describe(t) for t in texts])))

    return of(text)


def _strength(sites: DataFrame, mean: Column) -> float:
    """How many documents a prior is worth: by moments, from how far site means spread beyond chance.

    sites has n and s, the documents of a site and the sum of their evidence; `mean` is the
    prior mean. The result is at least 1 and at most 10,000.
    """
    chance = mean * (1 - mean)
    spread = F.sum((F.col("s") - F.col("n") * mean) ** 2 / F.col("n") - chance)
    found = sites.agg(spread.alias("spread"), F.sum(F.col("n") - 1).alias("n"), F.sum(F.col("n") * chance).alias("chance"), F.sum("n").alias("all")).first()
    if not found["n"] or not found["chance"]:
        return 10_000.0
    between = max(0.0, found["spread"]) / found["n"]
    mean_chance = found["chance"] / found["all"]
    return float(np.clip(mean_chance / between - 1, 1, 10_000)) if between > 0 else 10_000.0


def posterior(spark: SparkSession, found: DataFrame, rate: float) -> DataFrame:
    """Combine evidence with the site's, for found (doc_id, host, path, probability, known).

    known is the label where there is one, else the classifier's probability. A host's mean is
    shrunk towards the mean of all documents, a path's towards its host's, each the more the
    fewer documents it has; a document's own part is taken out of both first. The log odds of
    the path then shift the document's. Sites are grouped sums, a null host or path is a site
    of its own. Adds host_posterior, path_posterior and posterior.
    """
    sums = [F.count("*").cast("double").alias("n"), F.sum("known").alias("s")]
    paths = stored(spark, found.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = ((whole["s"] or 0) + rate) / ((whole["n"] or 0) + 1)
    host_strength = _strength(hosts, F.lit(mean))
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    shrunk = (F.col("host_s") + host_strength * mean) / (F.col("host_n") + host_strength)
    sites = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host")))
    sites = sites.select("p.host", "p.path", "n", "s", "host_n", "host_s")
    path_strength = _strength(sites, shrunk)
    same = F.col("d.host").eqNullSafe(F.col("s.host")) & F.col("d.path").eqNullSafe(F.col("s.path"))
    joined = found.alias("d").join(sites.alias("s"), same).select("d.*", "n", "s", "host_n", "host_s")
    host = (F.col("host_s") - F.col("known") + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    path = (F.col("s") - F.col("known") + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength)

    def bounded(p: Column) -> Column:
        return F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))

    def log_odds(p: Column) -> Column:
        return F.log(p / (1 - p))

    own = log_odds(F.least(F.greatest("probability", F.lit(1e-9)), F.lit(1 - 1e-9))) - float(logit(rate))
    total = F.least(F.greatest(own, F.lit(-SPREAD)), F.lit(SPREAD)) + log_odds(F.col("path_posterior"))
    return (
        joined.withColumn("host_posterior", bounded(host))
        .withColumn("path_posterior", bounded(path))
        .withColumn("posterior", 1 / (1 + F.exp(-total)))
        .drop("n", "s", "host_n", "host_s")
    )


def rate_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """doc_id, host, path, probability, host_posterior, path_posterior, posterior and kept for every row of docs.

    docs has doc_id, text, source (the host) and lang (the path below it); labels has doc_id
    and quality (0/1), and may be empty. Whole texts count; null and empty ones look alike.
    Repeated rows count once each and give repeated results.
    """
    return _rated(spark, docs, labels, bound, ["doc_id"]).select("doc_id", *RATED)


RATED = ["host", "path", "probability", "host_posterior", "path_posterior", "posterior", "kept"]


def _rated(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int, keys: list[str]) -> DataFrame:
    """rate_documents with other columns of docs to tell its rows by."""
    with arrow_rows(spark):
        classifier = learn(docs, labels, bound)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs.select(*{*keys, "doc_id"}, F.col("source").alias("host"), F.col("lang").alias("path"), evidence(classifier, text_bytes()).alias("probability"))
    with arrow_rows(spark):
        rows = stored(spark, rows, "evidence")
    # Rows without an id have no label; a join would bring them all to one task.
    named = rows.where("doc_id is not null").join(known, "doc_id", "left")
    rows = named.unionByName(rows.where("doc_id is null"), allowMissingColumns=True)
    rows = rows.withColumn("known", F.coalesce(F.col("quality").cast("double"), "probability")).drop("quality")
    return posterior(spark, rows, classifier.rate).withColumn("kept", F.col("posterior") >= THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """The documents of good quality, with all their columns.

    Every row is judged on its own, also among rows that share a doc_id or have none.
    """
    rows = keyed_rows(spark, docs)
    parts = [F.col(f"_row.{name}").alias(name) for name in ("doc_id", "text", "source", "lang")]
    rated = _rated(spark, rows.select("_row_key", *parts), labels, bound, ["_row_key"])
    return rows.join(rated.where("not kept").select("_row_key"), "_row_key", "left_anti").select("_row.*")
