"""The pipeline against brute force, and what holds for the package as a whole."""

import re
import subprocess
import sys
from collections import Counter
from itertools import combinations
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from brute import plain_components
from pyspark.sql import functions as F
from test_mixing import plain_mix
from test_packing import assert_packed, plain_pieces
from test_simhash import plain_fingerprint

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from clickmill.llm import common, quality, simhash, toxicity
from clickmill.llm.common import table
from clickmill.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What every stage returned, each given what the one before stored."""
    docs, kept = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        kept[name, "in"] = docs
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = kept[name] = spark.read.parquet(path)
    return kept


def ids(frame):
    return [r["doc_id"] for r in frame.select("doc_id").collect()]


def test_all_but_the_last_return_documents(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == COLUMNS


def test_rejected_documents_go(spark, sf_dir, stages):
    labels = table(spark, sf_dir, "labels")
    toxic = toxicity.classify(spark, stages["toxicity", "in"], labels).where("toxic")
    assert toxic.count() > 0
    assert sorted(ids(stages["toxicity"])) == sorted(set(ids(stages["toxicity", "in"])) - set(ids(toxic)))
    bad = quality.rate_documents(spark, stages["quality", "in"], labels).where("not kept")
    assert bad.count() > 0
    assert sorted(ids(stages["quality"])) == sorted(set(ids(stages["quality", "in"])) - set(ids(bad)))


def test_one_document_of_each_group_stays(stages):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in stages["simhash", "in"].collect()}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert sorted(ids(stages["simhash"])) == sorted(set(plain_components(prints, near).values()))


def test_documents_repeat_as_the_mix_says(stages):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in stages["mixing", "in"].collect()]
    plan, _ = plain_mix(docs)
    found = Counter(ids(stages["mixing"]))
    for doc_id, size, _, _, taken in plan:
        assert found[doc_id] * size == taken


def test_all_documents_are_packed(stages):
    docs = [r.asDict() for r in stages["packing", "in"].collect()]
    rows = stages["packing"].collect()
    found = sorted(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows)
    assert found == sorted(plain_pieces(docs, 4096))
    assert_packed(rows, 4096)


def test_run_is_the_stages(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset")
    expected = stages["packing"].drop("sequence_id", "offset")
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_no_clean_row_is_lost(spark, sf_dir, tmp_path_factory):
    """Shared and missing ids, repeated rows, a long text, an extra column named like an operator's own."""
    folder = tmp_path_factory.mktemp("odd")
    docs = table(spark, sf_dir, "documents").withColumn("_row_key", F.lit("x")).withColumn("piece", F.col("doc_id"))
    shared = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, 7).otherwise(F.col("doc_id"))
    long = docs.where("doc_id = 2").withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 300)).withColumn("piece", F.lit(-1))
    docs = docs.withColumn("doc_id", shared.cast("long")).unionByName(docs.where("doc_id < 30")).unionByName(long)
    docs.write.parquet(f"{folder}/documents.parquet")
    table(spark, sf_dir, "labels").write.parquet(f"{folder}/labels.parquet")
    docs, counts = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(folder))
        found.write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        counts.append((before.count(), docs.count()))
        if name == "quality":
            judged = quality.rate_documents(spark, before, table(spark, str(folder), "labels"))
            assert docs.count() == judged.where("kept").count() > 0.8 * before.count()
        if name == "simhash":
            texts = [{r["text"]: plain_fingerprint(r["text"]) for r in rows.select("text").distinct().collect()} for rows in (before, docs)]
            prints = sorted(set(texts[0].values()))
            near = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
            roots = plain_components(prints, near)
            # One row of each group, whatever ids its rows share.
            assert docs.count() == len(set(roots.values()))
            assert {roots[p] for p in texts[1].values()} == set(roots.values())
    assert counts[0][0] == table(spark, str(folder), "documents").count()
    assert 0.8 * counts[0][0] < counts[0][1] and all(n for _, n in counts)


@pytest.mark.parametrize("rows", ["empty", "null"])
def test_runs_on_tables_without_content(spark, sf_dir, tmp_path, rows):
    for name in ("documents", "labels"):
        part = table(spark, sf_dir, name).limit(0 if rows == "empty" else 4)
        part.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in part.schema)).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Four null rows are copies of each other, and the last holds no words to mix.
    assert len(found) <= (rows == "null")


PYTHON = re.compile("ArrowEvalPython|MapInPandas|MapInArrow")


@pytest.mark.parametrize(
    ("module", "run"),
    [
        (toxicity, lambda spark, docs, labels: toxicity.clean(spark, docs, labels)),
        (toxicity, lambda spark, docs, labels: toxicity.classify(spark, docs, labels)),
        (quality, lambda spark, docs, labels: quality.keep_good(spark, docs, labels)),
        (simhash, lambda spark, docs, labels: simhash.keep_one(spark, docs)),
        (simhash, lambda spark, docs, labels: simhash.near_duplicates(spark, docs)),
    ],
)
def test_few_whole_texts_at_once_go_to_python(spark, make_docs, labels, monkeypatch, module, run):
    """Batches of thousands of texts fill an executor's memory beside the heap, and stay there."""
    docs = make_docs([(i, f"some words of text {i} and a few more", "en", "a") for i in range(20)])
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, write = spark.conf.get(name), common.stored

    def watched(spark, rows, label):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        if PYTHON.search(plan) and "text" in plan:
            seen.append(int(spark.conf.get(name)))
        return write(spark, rows, label)

    monkeypatch.setattr(module, "stored", watched)
    monkeypatch.setattr(common, "stored", watched)
    found = run(spark, docs, labels)
    assert seen and max(seen) <= 1000
    assert not PYTHON.search(found._jdf.queryExecution().optimizedPlan().toString())
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    order = sorted(ours.columns)
    ours, theirs = (f[order].sort_values(order).reset_index(drop=True) for f in (ours, theirs))
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)


def test_every_operator_and_the_pipeline_are_registered():
    names = queries()
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names and QUERIES.items() <= names.items()
    assert set(oracle_sql()) <= set(names)


def test_the_rest_works_without_these_folders(tmp_path):
    """As the folders and the pipeline may be deleted, nothing else needs them."""
    root = Path(__file__).parents[2]
    for name in ("__spark_entry__.py", "clickmill"):
        (tmp_path / name).symlink_to(root / name)
    (tmp_path / "clickmill").unlink()
    (tmp_path / "clickmill").mkdir()
    for child in (root / "clickmill").iterdir():
        if child.name not in ("llm", "__pycache__"):
            (tmp_path / "clickmill" / child.name).symlink_to(child)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})


def test_no_other_module_imports_the_subpackage():
    root = Path(__file__).parents[2]
    for path in (root / "clickmill").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text())
