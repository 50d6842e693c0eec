import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import mixing, prefix
from clickmill.llm.queries import QUERIES


def plain_targets(sizes, weights, most):
    """Share out, cap, share the excess again, until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return share | fixed
        fixed |= {s: most * sizes[s] for s in over}


def plain_mix(docs, weights=(1, 2, 3), most=3):
    size = [len((d[1] or "").encode().split()) for d in docs]
    totals = Counter()
    for d, n in zip(docs, size):
        totals[d[3]] += n
    target = plain_targets(totals, weights, most)
    rows, before = [], Counter()
    order = sorted(range(len(docs)), key=lambda i: hashlib.md5(f"mix{'' if docs[i][0] is None else docs[i][0]}".encode()).hexdigest())
    for i in order:
        s = docs[i][3]
        passes = sum(k * totals[s] + before[s] + size[i] / 2 < target[s] for k in range(most))
        rows.append((docs[i][0], size[i], totals[s], pytest.approx(target[s], rel=1e-12), passes * size[i]))
        before[s] += size[i]
    return rows, target


def assert_mixed(found, docs):
    rows, target = plain_mix(docs)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    for r in found:
        ours = (r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])
        assert ours in by_id[r["doc_id"]]
        if "positions" in r:
            assert r["passes"] == len(r["positions"]) and all(0 <= p <= 1 for p in r["positions"])
            assert r["positions"] == sorted(r["positions"])
        else:
            times = [r["position"], r["position_2"], r["position_3"]]
            assert all(0 <= t <= 1 for t in times[: r["passes"]]) and times[r["passes"] :] == [-1] * (3 - r["passes"])
            assert times[: r["passes"]] == sorted(times[: r["passes"]])
    assert len(found) == len(rows)
    taken, longest = Counter(), Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s, t in target.items():
        assert abs(taken[s] - t) <= longest[s]


@pytest.mark.parametrize("window", [40, prefix.ROWS])
def test_matches_brute_force(spark, monkeypatch, sf_dir, tables, window):
    monkeypatch.setattr(prefix, "ROWS", window)
    docs = [(d["doc_id"], d["text"], d["lang"], d["source"]) for d in tables("documents")]
    found = QUERIES["op8_mixing"](spark, sf_dir).collect()
    assert_mixed(found, docs)
    assert [r["position"] for r in found] == sorted(r["position"] for r in found)
    assert any(r["passes"] > 1 for r in found)


@given(st.dictionaries(st.one_of(st.none(), st.text("abc", max_size=2)), st.integers(0, 1000), min_size=1))
@settings(max_examples=200, deadline=None)
def test_targets(sizes):
    found, plain = mixing.targets(sizes, (1, 2, 3), 3), plain_targets(sizes, (1, 2, 3), 3)
    for s in sizes:
        assert found[s] == pytest.approx(plain[s], abs=1e-6)
        assert found[s] <= 3 * sizes[s] + 1e-9


@given(st.lists(st.floats(0.01, 5), min_size=2, max_size=6), st.floats(0, 1))
@settings(max_examples=200, deadline=None)
def test_inverted_demand_integrates_back(weights, share):
    time = np.linspace(0, 1, len(weights))
    at = mixing.invert_demand(list(zip(time, weights)), np.array([share]))[0]
    fine = np.linspace(0, 1, 20_001)
    density = np.interp(fine, time, weights)
    demand = np.concatenate(([0], np.cumsum((density[1:] + density[:-1]) / 2)))
    assert np.interp(at, fine, demand / demand[-1]) == pytest.approx(share, abs=1e-3)


def test_edge_cases(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in edge_docs.collect()]
    assert_mixed(mixing.mix(spark, edge_docs).collect(), docs)
    assert mixing.mix(spark, no_docs).collect() == []
    assert mixing.take(spark, no_docs).collect() == []


def test_take_repeats_documents_in_order(spark, sf_dir, make_docs):
    docs = make_docs([(i, "w " * 10, "en", "a" if i < 40 else "c") for i in range(44)], extra="_position")
    plan = {r["doc_id"]: r for r in mixing.mix(spark, docs).collect()}
    rows = mixing.take(spark, docs)
    assert rows.columns == docs.columns
    ids = [r["doc_id"] for r in rows.collect()]
    assert Counter(ids) == Counter({i: r["passes"] for i, r in plan.items() if r["passes"]})
    left = {i: list(r["positions"]) for i, r in plan.items()}
    positions = [left[i].pop(0) for i in ids]
    assert positions == sorted(positions) and max(Counter(ids).values()) == 3


def test_take_ties_nothing_to_the_doc_id(spark, make_docs):
    """Rows without a doc_id, and different rows that share one, are taken as the mix says."""
    ids = [None if i % 3 == 0 else i % 7 for i in range(60)]
    docs = make_docs([(d, f"text{i} " * (i + 1), "en", "a" if i < 40 else "c") for i, d in enumerate(ids)], extra="_key")
    wanted = Counter((r["doc_id"], r["size"]) for r in mixing.mix(spark, docs).collect() for _ in range(r["passes"]))
    found = mixing.take(spark, docs).collect()
    assert None in {d for d, _ in wanted}
    assert Counter((r["doc_id"], len(r["text"].split())) for r in found) == wanted


def test_the_times_of_copies_are_found_once(spark, make_docs):
    """A second call of the same function would need a second Python worker beside the first in every task."""
    docs = make_docs([(i, "some words of a text " * (i % 5), "en", "ab"[i % 2]) for i in range(40)])
    plan = mixing.take(spark, docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
