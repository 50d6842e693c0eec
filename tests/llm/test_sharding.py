import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickmill.llm import sharding
from clickmill.llm.queries import QUERIES


def assert_dealt(rows, docs, shards, slack):
    text = Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == text
    size = Counter()
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
        size[s] = sum(r["size"] for r in rows if r["shard"] == s)
    assert all(0 <= r["shard"] < shards for r in rows)
    share = sum(size.values()) / shards
    assert all(abs(n - share) <= slack for n in size.values())


def test_query(spark, sf_dir, tables):
    docs = [(d["doc_id"], d["text"]) for d in tables("documents")]
    rows = QUERIES["op6_sharding"](spark, sf_dir).collect()
    longest = max(len((t or "").encode()) for _, t in docs) + 1
    assert_dealt(rows, docs, 8, 2 * longest)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    where = {r["doc_id"]: r["shard"] for r in rows}
    shards_of = {}
    for i, t in docs:
        shards_of.setdefault(t, set()).add(where[i])
    copies = [s for t, s in shards_of.items() if sum(x == t for _, x in docs) > 1]
    assert copies and all(len(s) == 1 for s in copies)


@pytest.mark.parametrize("range_rows", [20, sharding.RANGE_ROWS])
def test_hot_group_is_dealt_over_shards(spark, monkeypatch, make_docs, range_rows):
    """A third of all rows have one text; the ranges are small enough to be split again."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    docs = [(i, "hot text" if i % 3 == 0 else f"text {i} " * (i % 17), "en", "a") for i in range(3000)]
    rows = sharding.shard(spark, make_docs(docs), 8).collect()
    assert_dealt(rows, docs, 8, 2 * max(len(d[1]) for d in docs))
    assert rows == sharding.shard(spark, make_docs(docs), 8).collect() or sorted(rows) == sorted(sharding.shard(spark, make_docs(docs), 8).collect())


def plain_shards(docs, keys, shards):
    """The whole query without ranges: (doc_id, size, crc, shard, slot) of every row, in the order of the texts' hashes."""
    rows = sorted((k, -(1 << 63) if i is None else i, i, (t or "").encode()) for (i, t), k in zip(docs, keys))
    total = sum(len(t) + 1 for *_, t in rows)
    group = Counter()
    for key, *_, t in rows:
        group[key] += len(t) + 1
    out, end, start, slots = [], 0, {}, Counter()
    for key, _, i, t in rows:
        size = len(t) + 1
        start.setdefault(key, end)
        end += size
        kept = group[key] * shards * sharding.WHOLE <= total
        middle = start[key] + group[key] / 2 if kept else end - size / 2
        shard = min(int(middle * shards / total), shards - 1)
        out.append((i, size, zlib.crc32(t), shard, slots[shard]))
        slots[shard] += 1
    return Counter(out)


@pytest.mark.parametrize("range_rows", [30, sharding.RANGE_ROWS])
def test_matches_brute_force(spark, monkeypatch, sf_dir, range_rows):
    """However the rows fall in ranges, and where ranges cut groups of equal texts."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = [(10**9 + i, None if i % 2 else "often") for i in range(300)]
    docs = table.unionByName(spark.createDataFrame(more, table.schema))
    found = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")), F.lit(sharding.SEED)).alias("key")).collect()
    expected = plain_shards([(r["doc_id"], r["text"]) for r in found], [r["key"] for r in found], 8)
    assert Counter(map(tuple, sharding.shard(spark, docs, 8).collect())) == expected


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: None, lambda i: 7])
def test_no_range_has_too_many_rows(spark, monkeypatch, make_docs, ids):
    """Two thirds of all rows are null texts, which are few bytes; they lie in many ranges and in one shard."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    docs = [(ids(i), None if i % 3 else f"text {i} " * 200, "en", "a") for i in range(3000)]
    kept = []
    cut = sharding.cut_ranges
    monkeypatch.setattr(sharding, "cut_ranges", lambda *a: kept.append(cut(*a)) or kept[0])
    rows = sharding.shard(spark, make_docs(docs), 8).collect()
    found = kept[0][1]
    assert found["rows"].sum() == 3000 and found["rows"].max() <= 4 * 50
    assert_dealt(rows, docs, 8, 2 * 2000)
    assert len({r["shard"] for r in rows if r["size"] == 1}) == 1


def test_edge_cases(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert_dealt(sharding.shard(spark, edge_docs, 3).collect(), docs, 3, 1 << 20)
    assert sharding.shard(spark, no_docs, 3).collect() == []


def test_one_key_for_all_rows(spark, make_docs):
    docs = [(7, "same", "en", "a")] * 500
    assert_dealt(sharding.shard(spark, make_docs(docs), 8).collect(), docs, 8, 10)
