import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import packing, prefix
from clickmill.llm.queries import QUERIES, word_tokenizer


def plain_pieces(docs, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    rows = []
    for d in docs:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            rows.append((d["doc_id"], piece, start, len(part), zlib.crc32(part.tobytes())))
    return rows


def assert_packed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_matches_brute_force(spark, sf_dir, tables):
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    found = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows]
    assert sorted(found) == sorted(plain_pieces(tables("documents"), 4096))
    used = assert_packed(rows, 4096)
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert used <= least + max(1, least // 100)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=7), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_best_subset_sum(counts, space):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= space}
    chosen = packing.fullest(counts, space)
    assert sum(chosen) == max(sums)
    assert not Counter(chosen) - Counter(counts)


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=30))
@settings(max_examples=100, deadline=None)
def test_patterns_use_every_length_up(counts):
    used = Counter()
    for chosen, times in packing.patterns(counts, 50):
        assert sum(chosen) <= 50
        for length, n in Counter(chosen).items():
            used[length] += n * times
    assert used == Counter(counts)


def test_cached_words_make_the_tokenizers_ids(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED", 5)
    words = packing.WordIds(word_tokenizer())
    plain = Tokenizer.from_file(word_tokenizer())
    texts = ["", " ", "It's a test, isn't it?\x1c x\x85y", "é É ́alone İstanbul ΣΑΣ ﬁ", "naïve ÄÖÜß 漢字かな 1234 5 a1b2 🙂🙂", "they'll we've I'd 's ' re", "Å A ̊"]
    texts += ["H\u0331. \u1e96, \u0130. \u0915\u093c. \u0958. HELLO, hello. a.. b,, c.,"]
    for batch in (texts, texts[::-1], texts[:1], texts[5:]):
        ids, lengths = words.of([t.encode() for t in batch])
        expected = [plain.encode(t, add_special_tokens=False).ids for t in batch]
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == sum(expected, [])


@pytest.mark.parametrize("window", [3, prefix.ROWS])
def test_edge_cases(spark, monkeypatch, edge_docs, no_docs, window):
    monkeypatch.setattr(prefix, "ROWS", window)
    rows = packing.pack(spark, edge_docs, word_tokenizer(), capacity=64).collect()
    assert Counter(r["doc_id"] for r in rows)[1] == 1
    assert sum(r["doc_id"] == 3 for r in rows) == 2 and any(r["doc_id"] is None for r in rows)
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == 30_001
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert_packed(rows, 64)
    assert packing.pack(spark, no_docs, word_tokenizer()).collect() == []


def test_special_tokens_in_a_text_are_as_the_tokenizer_has_them():
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "Ab<|startoftext|>CD<|endoftext|>. <|ENDOFTEXT|> x<|endoftext|", "<|endoftext|>" * 3, "Plain, words."]
    plain, words = Tokenizer.from_file(word_tokenizer()), packing.WordIds(word_tokenizer())
    expected = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert 49407 in expected[0] and 49406 in expected[1]
    ids, lengths = words.of([text.encode() for text in texts])
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == [i for e in expected for i in e]


def test_marks_after_a_word_are_tokenised_once(monkeypatch):
    """Of words with marks after them only the marks are left to the whole tokenizer, once each."""
    from tokenizers import Tokenizer

    plain, words, asked = Tokenizer.from_file(word_tokenizer()), packing.WordIds(word_tokenizer()), []

    class Recorder:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    words.tokenizer = Recorder()
    texts = ["Wort!! größe$$$, wort$$$, b.", "naïve!! wort&&&. c_ c<| wort", "$$$, !! wort's it's! (wort) wort'"]
    ids, lengths = words.of([text.encode() for text in texts])
    expected = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert lengths.tolist() == [len(e) for e in expected]
    assert ids.tolist() == sum(expected, [])
    assert sorted(asked) == sorted(["!!", "$$$,", ".", "&&&.", "_", "<|", "wort's", "it's!", "(wort)", "wort'"])
