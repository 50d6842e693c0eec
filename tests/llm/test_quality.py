import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmill.llm import quality
from clickmill.llm.queries import QUERIES
from clickmill.llm.training import fit_dense, sigmoid

FOUND = "doc_id long, host string, path string, probability double, known double"


def plain_posterior(rows, rate):
    """The same sums, site by site."""
    def mean_of(items):
        return sum(r[4] for r in items), len(items)

    hosts, paths = {}, {}
    for r in rows:
        hosts.setdefault(r[1], []).append(r)
        paths.setdefault(r[1:3], []).append(r)
    s, n = mean_of(rows)
    mean = (s + rate) / (n + 1)

    def strength(sites, prior):
        spread = sum((s - n * p) ** 2 / n - p * (1 - p) for (s, n), p in zip(sites, prior))
        chance = sum(n * p * (1 - p) for (_, n), p in zip(sites, prior)) / sum(n for _, n in sites)
        rest = sum(n - 1 for _, n in sites)
        between = max(0, spread) / rest if rest else 0
        return float(np.clip(chance / between - 1, 1, 10_000)) if between > 0 else 10_000.0

    host_sums = {h: mean_of(x) for h, x in hosts.items()}
    k = strength(list(host_sums.values()), [mean] * len(hosts))
    shrunk = {h: (s + k * mean) / (n + k) for h, (s, n) in host_sums.items()}
    path_sums = {p: mean_of(x) for p, x in paths.items()}
    j = strength(list(path_sums.values()), [shrunk[p[0]] for p in path_sums])
    out = []
    for r in rows:
        hs, hn = host_sums[r[1]]
        host = (hs - r[4] + k * mean) / (hn - 1 + k)
        ps, pn = path_sums[r[1:3]]
        path = (ps - r[4] + j * host) / (pn - 1 + j)
        own = np.clip(np.log(r[3] / (1 - r[3])) - np.log(rate / (1 - rate)), -quality.SPREAD, quality.SPREAD)
        out.append((host, path, 1 / (1 + np.exp(-(own + np.log(path / (1 - path)))))))
    return out


def test_posterior_matches_brute_force(spark):
    random = np.random.default_rng(0)
    hosts = {f"h{i}": random.beta(4, 2) for i in range(12)} | {None: 0.4}
    rows = []
    for i in range(800):
        host = list(hosts)[min(12, int(random.exponential(3)))]
        path = [None, "a", "b"][random.integers(3)]
        good = np.clip(hosts[host] + (0.2 if path == "a" else 0), 0.05, 0.95)
        p = float(np.clip(random.beta(8 * good, 8 * (1 - good)), 0.001, 0.999))
        rows.append((i, host, path, p, float(random.random() < good) if i % 4 == 0 else p))
    found = quality.posterior(spark, spark.createDataFrame(rows, FOUND), 0.7).orderBy("doc_id").collect()
    ours = [(r["host_posterior"], r["path_posterior"], r["posterior"]) for r in found]
    assert np.array(ours) == pytest.approx(np.array(plain_posterior(rows, 0.7)), rel=1e-9)


def test_sparse_sites_shrink_to_the_prior(spark):
    """Sites of one document take the prior, large ones their own mean."""
    rows = [(i, "good", "x", 0.95, 0.95) for i in range(200)] + [(200 + i, "bad", "x", 0.1, 0.1) for i in range(200)]
    rows += [(1000 + i, f"tiny{i}", "x", 0.6, 0.6) for i in range(50)]
    found = {r["doc_id"]: r for r in quality.posterior(spark, spark.createDataFrame(rows, FOUND), 0.6).collect()}
    assert found[0]["path_posterior"] > 0.85 and found[200]["path_posterior"] < 0.2
    whole = sum(r[4] for r in rows) / len(rows)
    assert found[1000]["path_posterior"] == pytest.approx(whole, abs=0.02)
    # The same evidence counts for more on a good site.
    assert found[0]["posterior"] > 0.95


def test_dense_regression_is_at_its_optimum():
    random = np.random.default_rng(3)
    x = random.normal(size=(300, 4))
    label = (random.random(300) < sigmoid(x @ np.array([1, -2, 0, 0.5]) + 0.3)).astype(float)
    w = fit_dense(x, label)
    full = np.column_stack([x, np.ones(300)])
    slope = full.T @ (label - sigmoid(full @ w)) - np.append(w[:-1], 0)
    assert np.abs(slope).max() < 1e-3


def test_given_labels_out_of_sample(spark, sf_dir, tables):
    truth = {r["doc_id"]: r["quality"] for r in tables("labels")}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rated = quality.rate_documents(spark, docs, labels.where("doc_id % 2 = 0")).collect()
    assert len(rated) == len(tables("documents"))
    held = [r for r in rated if r["doc_id"] % 2 == 1 and r["doc_id"] in truth]
    wrong = [r["doc_id"] for r in held if r["kept"] != bool(truth[r["doc_id"]])]
    assert len(wrong) <= 0.03 * len(held)


def test_edge_cases(spark, edge_docs, no_docs, labels):
    rows = quality.rate_documents(spark, edge_docs, labels).collect()
    assert len(rows) == 8 and all(0 < r["posterior"] < 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len(quality.rate_documents(spark, edge_docs, none).collect()) == 8
    nulls = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, quality int")
    assert len(quality.rate_documents(spark, edge_docs, nulls).collect()) == 8
    assert quality.rate_documents(spark, no_docs, labels).collect() == []
    kept = quality.keep_good(spark, edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert quality.keep_good(spark, no_docs, labels).collect() == []


def test_rows_that_share_an_id_or_have_none_are_judged_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("doc_id >= 200")
    rated = quality.rate_documents(spark, docs, labels)
    bad = rated.where("not kept and doc_id >= 200").first()["doc_id"]
    assert 0 < rated.where("doc_id < 200 and not kept").count() < 200

    def kept(new_id):
        changed = docs.withColumn("number", F.col("doc_id")).withColumn("doc_id", F.when(F.col("doc_id") < 200, new_id).otherwise(F.col("doc_id")))
        return {r["number"] for r in quality.keep_good(spark, changed.repartition(5), labels).collect()}

    good = {r["doc_id"] for r in rated.where("kept").collect()}
    # A label of the shared id is one of all its rows; only the evidence of these sites moves by that.
    assert len(good ^ kept(F.lit(None).cast("long"))) <= 2
    assert len(good ^ kept(F.lit(bad))) <= 10


def test_query_has_a_row_for_each_document(spark, sf_dir, tables):
    rows = QUERIES["op1_quality"](spark, sf_dir)
    assert rows.select("doc_id").distinct().count() == rows.count() == len(tables("documents"))
    assert rows.where(F.col("kept") != (F.col("posterior") >= quality.THRESHOLD)).count() == 0
