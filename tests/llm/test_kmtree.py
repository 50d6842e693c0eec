import numpy as np
from pyspark.sql import functions as F

from clickmill.llm import kmtree
from clickmill.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, leaf string"


def brute_force(rows, queries, k):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q, vector in queries:
        score = np.sqrt(((vectors - np.array(vector, np.float64)) ** 2).sum(axis=1))
        order = np.lexsort((ids, score))
        out[q] = [(int(ids[i]), score[i]) for i in order if ids[i] != q][:k]
    return out


def recall(found, exact):
    hits = sum(len({v for v, _ in exact[q]} & {v for v, _ in found.get(q, [])}) for q in exact)
    return hits / sum(map(len, exact.values()))


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_on_given_table(spark, sf_dir, tables):
    rows = [(r["vec_id"], r["embedding"]) for r in tables("embeddings")]
    exact = brute_force(rows, [r for r in rows if r[0] % 100 == 0], 10)
    found = as_lists(QUERIES["op4_ann"](spark, sf_dir).collect())
    assert all([rank for rank, _ in enumerate(v)] == list(range(10)) for v in found.values())
    assert recall(found, exact) >= 0.9
    true = dict(rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0]))
        for v, score in near:
            assert score == np.sqrt(((np.array(true[v], float) - np.array(true[q], float)) ** 2).sum())


def test_recall_ties_and_hot_vector(spark, monkeypatch):
    """A third of all rows are one vector; its leaf is cut in parts."""
    monkeypatch.setattr(kmtree, "PART", 100)
    random = np.random.default_rng(0)
    centres = random.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + 0.3 * random.normal(size=16)).astype(np.float32).tolist() if i % 3 else [1.0] * 16, 0, "x") for i in range(3000)]
    exact = brute_force(rows, [r[:2] for r in rows if r[0] % 50 == 0], 10)
    found = as_lists(kmtree.search(spark, spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, sample=1000).collect())
    assert set(found) == set(exact) and recall(found, exact) >= 0.9
    assert found[0] == [(i, 0.0) for i in range(3, 33, 3)]


def test_every_length_is_searched(spark):
    """Vectors of a rarer length have neighbours of their length, and no others."""
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=8 if i % 4 else 3).astype(np.float32).tolist(), 0, "x") for i in range(400)]
    rows.append((1000, [1.0], 0, "x"))
    found = as_lists(kmtree.search(spark, spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect())
    expected = {}
    for size in (3, 8):
        own = [r for r in rows if len(r[1]) == size]
        expected |= brute_force(own, [r[:2] for r in own if r[0] % 50 == 0], 10)
    assert set(found) == set(expected) and recall(found, expected) >= 0.9


def test_few_and_unusable_vectors(spark):
    bad = [None, [0.0, 0.0], [float("nan"), 1.0], [None, 1.0], []]
    rows = [(i, v, 0, "x") for i, v in enumerate(bad)] + [(10, [1.0, 0.0], 1, "x"), (11, [0.0, 1.0], None, None), (12, [1.0, 1.0], 1, "x"), (None, [1.0, 0.5], 1, "x"), (13, [1.0], 1, "x")]
    found = as_lists(kmtree.search(spark, spark.createDataFrame(rows, SCHEMA), F.lit(True)).collect())
    assert {q: [v for v, _ in near] for q, near in found.items()} == {10: [12, 11], 11: [12, 10], 12: [10, 11]}
    assert kmtree.search(spark, spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert kmtree.search(spark, spark.createDataFrame(rows[-2:], SCHEMA), F.lit(False)).collect() == []
