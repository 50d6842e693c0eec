import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import brown
from clickmill.llm.queries import QUERIES

BASE_WEIGHT = 0.1


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def base_scores(docs):
    counts = Counter(w for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 7 != 2 for w in tokens(d["text"]))
    n, v = sum(counts.values()), len(counts)
    rows = {}
    for d in docs:
        own = tokens(d["text"])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        rows[d["doc_id"]] = len(own), sum(counts[w] > 0 for w in own), n, base
    return rows


def test_counts_and_base_match_brute_force(spark, sf_dir, tables):
    docs = tables("documents")
    expected = base_scores(docs)
    found = {r["doc_id"]: r for r in QUERIES["op3_lm_scoring"](spark, sf_dir).collect()}
    assert found.keys() == expected.keys()
    for i, (n, known, train, base) in expected.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_score(texts, trained, classes):
    """The model's formula, token by token; classes maps each word of training to its class."""
    counts = Counter(w for t, use in zip(texts, trained) if use for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    pairs, size = Counter(), Counter()
    for text, use in zip(texts, trained):
        before = None
        for w in tokens(text) if use else []:
            pairs[classes[before], classes[w]] += 1
            size[classes[w]] += 1
            before = w
    after = Counter()
    for (c, _), k in pairs.items():
        after[c] += k
    out = []
    for text in texts:
        total, before = 0.0, None
        for w in tokens(text):
            p = BASE_WEIGHT * (counts[w] + 1) / (n + v + 1)
            if w in classes:
                d, share = classes[w], size[classes[w]] / n
                if before in classes:
                    c = classes[before]
                    share = (pairs[c, d] + brown.SMOOTHING * share) / (after[c] + brown.SMOOTHING)
                p += (1 - BASE_WEIGHT) * share * counts[w] / size[d]
            total += math.log10(p)
            before = w
        out.append(total)
    return out


@pytest.mark.parametrize("block", [300, brown.BLOCK_BYTES])
def test_score_is_the_models(spark, monkeypatch, make_docs, block):
    """Scores follow from the classes by the stated formula, however the texts fall in blocks."""
    monkeypatch.setattr(brown, "BLOCK_BYTES", block)
    random = np.random.default_rng(5)
    words = [[f"{g}{i}" for i in range(12)] for g in "xyz"]
    texts = [" ".join(random.choice(words[i % 3]) for _ in range(40)) for i in range(60)]
    docs = make_docs([(i, t, "en", "a") for i, t in enumerate(texts)])
    monkeypatch.setattr(brown, "_base_weight", lambda *_: BASE_WEIGHT)
    kept = {}
    cluster = brown.cluster
    monkeypatch.setattr(brown, "cluster", lambda *a: kept.setdefault("classes", cluster(*a)))
    trained = [i % 5 != 0 for i in range(60)]
    found = brown.score(spark, docs, F.col("doc_id") % 5 != 0, classes=4).orderBy("doc_id").collect()
    of = {}
    for row in kept["classes"].collect():
        of.update(zip(np.frombuffer(row["hashes"], np.uint64).tolist(), row["classes"]))
    import xxhash

    vocabulary = {w for t, use in zip(texts, trained) if use for w in tokens(t)}
    classes = {w: of[xxhash.xxh64_intdigest(brown.END if w is None else w)] for w in vocabulary}
    assert [r["score"] for r in found] == pytest.approx(plain_score(texts, trained, classes), rel=1e-9)


def test_exchange_finds_the_groups_of_words(spark, monkeypatch, make_docs):
    """Words that follow one another get classes apart from those that never meet them."""
    random = np.random.default_rng(7)
    words = [[f"{g}{i}" for i in range(40)] for g in "xyz"]
    texts = [" ".join(random.choice(words[i % 3]) for _ in range(60)) for i in range(300)]
    docs = make_docs([(i, t, "en", "a") for i, t in enumerate(texts)])
    rows = brown.score(spark, docs, F.lit(True), classes=8).collect()
    # Knowing the group saves log10(3) a word.
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert gain > 0.3


def test_edge_cases(spark, edge_docs, no_docs):
    rows = brown.score(spark, edge_docs, F.col("doc_id") != 4).collect()
    assert len(rows) == 8
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == 1 and by_id[1]["n_known"] == 1
    assert by_id[4]["n_known"] == 7 and by_id[None]["n_known"] == 1
    assert by_id[5]["n_tokens"] == 30_001
    untrained = brown.score(spark, edge_docs, F.lit(False)).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in untrained} == {(0, 0, 0.0, 0.0)}
    assert brown.score(spark, no_docs, F.lit(True)).collect() == []


def test_base_weight_is_the_likeliest():
    cells, n = np.array([0, 150, 215, 260]), np.array([30.0, 20.0, 100.0, 50.0])
    ratio = np.array([0, *2.0 ** ((cells[1:] - 1 - 200) / 10)])
    found = brown._base_weight(cells, n)
    weights = np.linspace(0.001, 0.999, 999)
    likelihood = [(n * np.log(w + (1 - w) * ratio)).sum() for w in weights]
    assert found == pytest.approx(weights[np.argmax(likelihood)], abs=0.01)
