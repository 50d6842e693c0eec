import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import decontamination
from clickmill.llm.decontamination import WindowSet, search, without
from clickmill.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items, window):
    """Numbers of hit words and ids of the items found, each window compared with each place."""
    w, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        v = plain_words(item)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit.update(range(j, j + n))
                    found |= {str(item_id)} - {"None"}
    return len(w), hit, sorted(found)


TEXT = st.lists(st.sampled_from(["a", "B", "c.", "é", "É", "1"]), max_size=12).map(" ".join)


@given(st.lists(TEXT, max_size=4), st.lists(TEXT, max_size=4), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_search_matches_brute_force(texts, items, window):
    named = list(enumerate(items))
    windows = WindowSet([(str(i), t.encode()) for i, t in named], window)
    found = search([t.encode() for t in texts], windows, [[] for _ in texts])
    for text, (n, spans, names) in zip(texts, found, strict=True):
        expected = plain_hits(text, named, window)
        hit = {i for a, b in zip(spans[::2], spans[1::2]) for i in range(a, b)}
        assert (n, hit, sorted(names)) == expected
        assert all(a < b for a, b in zip(spans, spans[1:]))


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontamination, "_hashes", lambda ids, n: decontamination.np.zeros(max(0, len(ids) - n + 1), "u8"))
    windows = WindowSet([("1", b"a b c"), ("2", b"b c d"), ("3", b"x")], 2)
    assert list(search([b"z b c x", b"a b"], windows, [[], []])) == [(4, [1, 4], {"1", "2", "3"}), (2, [0, 2], {"1"})]


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it rests."),
    (1, "The quick brown fox jumps over the lazy dog and then it rests."),
    (10, "and then it rests. Nothing else happens on this long and quiet afternoon here"),
    (2, "Two words"),
    (None, "a nameless item"),
    (3, None),
    (4, ""),
    (5, " .,! "),
]
TEXTS = [
    (1, "So: THE QUICK BROWN FOX, jumps over the lazy dog -- and more."),
    (2, "two, words"),
    (3, "the quick brown fox jumps over the lazy cat"),
    (4, None),
    (5, ""),
    (None, "A nameless item; TWO words!"),
    (6, "filler " * 20_000 + "two words " + "filler " * 20_000 + ITEMS[0][1] + ITEMS[2][1][18:]),
    (2, "two, words"),
]


@pytest.fixture
def leaky(make_docs):
    return make_docs([(i, t, "en", "s") for i, t in TEXTS], extra="n_hit")


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("part_words", [10, decontamination.PART_WORDS])
def test_edge_cases(spark, monkeypatch, leaky, items, part_words):
    """The same result whether the items make one set or one each."""
    monkeypatch.setattr(decontamination, "PART_WORDS", part_words)
    rows = decontamination.find(spark, leaky, items).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, hit, names = plain_hits(r["row"]["text"], ITEMS, 10)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), names)
    assert max(r["n_hit"] for r in rows) > 20


def test_spans_and_documents_go(spark, leaky, items, no_docs):
    kept = decontamination.clean_documents(spark, leaky, items)
    assert kept.columns == leaky.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
    cut = decontamination.clean_spans(spark, leaky, items)
    assert cut.columns == leaky.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[1] == "So:  more." and texts[2] == "" and texts[None] == "!"
    assert texts[3] == TEXTS[2][1]
    assert texts[4] is None and texts[5] == ""
    again = decontamination.find(spark, cut, items)
    assert again.where("n_hit > 0").count() == 0
    assert decontamination.find(spark, no_docs, items).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find(spark, leaky, none).where("n_hit > 0").count() == 0
    assert decontamination.clean_documents(spark, leaky, none).count() == len(TEXTS)


def test_what_is_cut():
    assert without("Ein Café, heute: zu".encode(), [1, 3]).decode() == "Ein : zu"
    assert without(b"one two three", [0, 1, 2, 3]) == b" two "


def test_query_matches_brute_force(spark, sf_dir, tables):
    items = [(r["item_id"], r["text"]) for r in tables("benchmark")]
    grams = {}
    for item_id, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            grams.setdefault(tuple(w[i : i + 10]), set()).add(str(item_id))
    found = {r["doc_id"]: r for r in QUERIES["op13_decontamination"](spark, sf_dir).collect()}
    docs = tables("documents")
    assert len(found) == len(docs)
    for d in docs:
        w, hit, names = plain_words(d["text"]), set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in grams:
                    hit.update(range(j, j + n))
                    names |= grams[tuple(w[j : j + n])]
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(names))
        assert r["items_sha256"] == sha256(",".join(sorted(names)).encode()).hexdigest()
        assert r["contaminated"] == bool(hit)
    assert sum(r["contaminated"] for r in found.values()) > 0
