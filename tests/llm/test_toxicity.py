import numpy as np
import pytest

from clickmill.llm import toxicity
from clickmill.llm.training import Sparse, fit_sparse, sigmoid

CLEAN = "the rain in spain stays mainly on a plain where green trees grow near old stone walls".split()
RUDE = {"en": ["idiot", "moron", "scumbag"], "de": ["dummkopf", "dummling", "dummbatz"], "fr": ["cretinou", "cretineux", "cretiniste"]}


def corpus(random, count):
    rows, labels = [], []
    for i in range(count):
        lang = ["en", "de", "fr"][i % 3]
        words = list(random.choice(CLEAN, 30))
        toxic = int(random.random() < 0.3)
        if toxic:
            for _ in range(2):
                words.insert(random.integers(len(words)), str(random.choice(RUDE[lang][:2])))
        rows.append((i, " ".join(words), lang, "a"))
        labels.append((i, toxic, 1))
    return rows, labels


LABELS = "doc_id long, toxic int, quality int"


def test_held_out_documents_and_unseen_endings(spark, make_docs):
    rows, labels = corpus(np.random.default_rng(1), 900)
    unseen = [(2000, "the old " + RUDE["de"][2] + " walks on", "de", "a"), (2001, " ".join(CLEAN), "de", "a")]
    docs = make_docs(rows + unseen, extra="probability")
    train = [x for x in labels if x[0] < 600]
    found = {r["doc_id"]: r for r in toxicity.classify(spark, docs, spark.createDataFrame(train, LABELS)).collect()}
    truth = {i: bool(t) for i, t, _ in labels}
    assert sum(found[i]["toxic"] != truth[i] for i in range(600, 900)) <= 3
    assert found[2000]["toxic"] and not found[2001]["toxic"]
    categories = found[0]["categories"]
    assert set(categories) == {"toxic_en", "toxic_de", "toxic_fr", "toxic"}
    german = [i for i in range(600, 900) if i % 3 == 1 and truth[i]]
    assert np.mean([found[i]["categories"]["toxic_de"] for i in german]) > 0.5
    assert np.mean([found[i]["categories"]["toxic_fr"] for i in german]) < 0.3


def test_later_models_weigh_the_earlier_probabilities(spark, make_docs):
    """A category that follows from the one before, but from no word, is learnt through the chain."""
    random = np.random.default_rng(2)
    rows, labels = corpus(random, 600)
    sample = spark.createDataFrame([(i, t, labels[i][1], labels[i][1]) for i, t, *_ in rows], "doc_id long, text string, first int, second int")
    chain = toxicity.fit(spark, sample, ["first", "second"])
    assert len(chain.earlier[0]) == 0 and len(chain.earlier[1]) == 1
    assert chain.earlier[1][0] > 0.5
    assert len(chain.probabilities(rows[0][1])) == 2


def test_sparse_regression_matches_plain_descent():
    random = np.random.default_rng(3)
    dense = random.random((200, 2))
    hot = random.random((200, 6)) < 0.3
    label = (random.random(200) < sigmoid(hot @ np.array([2, -1, 0, 1, 0, -2]) + dense @ np.array([1, -1]))).astype(float)
    found = fit_sparse(Sparse([np.flatnonzero(r) for r in hot], 6), dense, label, np.ones(200), penalty=0.5, steps=3000)
    x = np.column_stack([hot, dense, np.ones(200)])
    weights = np.zeros(9)
    for _ in range(20_000):
        slope = x.T @ (sigmoid(x @ weights) - label) + 0.5 * np.append(weights[:-1], 0)
        weights -= 0.01 * slope
    assert np.concatenate([found[0], found[1], [found[2]]]) == pytest.approx(weights, abs=1e-3)


def test_threshold_has_the_fewest_errors():
    random = np.random.default_rng(4)
    for _ in range(50):
        p = np.round(random.random(30), 1)
        label = (random.random(30) < p).astype(float)
        if not 0 < label.sum() < 30:
            continue
        found = toxicity.best_threshold(p, label)

        def errors(t):
            return ((p < t) & (label == 1)).sum() + ((p >= t) & (label == 0)).sum()

        assert errors(found) == min(errors(t) for t in np.unique(p)[1:] - 0.05)
    assert 0.01 < toxicity.best_threshold(np.array([0.001, 0.01, 0.4, 0.9]), np.array([0.0, 0, 1, 1])) < 0.4


def test_edge_cases(spark, edge_docs, no_docs, labels):
    rows = toxicity.classify(spark, edge_docs, labels).collect()
    assert len(rows) == 8 and all(0 <= r["probability"] <= 1 for r in rows)
    none = spark.createDataFrame([], LABELS)
    assert [r["toxic"] for r in toxicity.classify(spark, edge_docs, none).collect()] == [False] * 8
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (2, 0, 0)], LABELS)
    assert len(toxicity.classify(spark, edge_docs, nulls).collect()) == 8
    assert toxicity.classify(spark, no_docs, labels).collect() == []
    kept = toxicity.clean(spark, edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.count() == 8


def test_given_labels(spark, sf_dir, tables):
    from clickmill.llm.queries import QUERIES

    truth = {r["doc_id"]: r["toxic"] for r in tables("labels")}
    found = {r["doc_id"]: r["toxic"] for r in QUERIES["op5_toxicity"](spark, sf_dir).collect()}
    assert len(found) == len(tables("documents"))
    wrong = [i for i, t in truth.items() if found[i] != bool(t)]
    assert len(wrong) <= 0.01 * len(truth)


def test_counting_in_parts_gives_the_same_features(spark, monkeypatch):
    """A task passes its counts on whenever it holds many; they add up to the same."""
    rows, labels = corpus(np.random.default_rng(5), 300)
    sample = spark.createDataFrame([(t, labels[i][1]) for i, t, *_ in rows], "text string, first int").coalesce(1)
    whole = toxicity._select(sample, ["first"])
    monkeypatch.setattr(toxicity, "COUNTED", 20)
    assert toxicity._select(sample, ["first"]) == whole and any(whole)
