from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import alignment
from clickmill.llm.queries import QUERIES, tokenizer

PATHS = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Both sides' ids and token bytes straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    bytewise = Tokenizer.from_file(PATHS[0])
    bytewise.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}

    def encode(text):
        a = bytewise.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        a = [(i, bytes(of[c] for c in bytewise.id_to_token(i))) for i in a]
        b = [(i, bytes([int(pieces.id_to_piece(i)[3:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in b]
        return a, b

    return encode


def plain_alignment(text, encode):
    """n_a, n_b, groups and links, byte by byte; None without tokens."""
    if not text:
        return None
    sides = encode(text)
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in sides):
        return None
    owner = [[(k, i) for k, (i, t) in enumerate(side) for _ in t] for side in sides]
    links = {(x, y) for x, y in zip(*owner)}
    groups, group = [], ([], [])
    for at, (x, y) in enumerate(zip(*owner)):
        ends = [at + 1 == len(whole) or own[at + 1] != own[at] for own in owner]
        for side, token, end in zip(group, (x, y), ends):
            if end:
                side.append(str(token[1]))
        if all(ends):
            groups.append("|".join(map(",".join, group)))
            group = ([], [])
    return len(sides[0]), len(sides[1]), groups, [(x[1], y[1]) for x, y in links]


def plain_counts(texts, encode):
    found = [plain_alignment(t, encode) for t in texts]
    count = Counter(pair for f in found if f for pair in set(f[3]))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    for f in found:
        if f is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, groups, links = f
            best = sum(count[link] == highest[link[0]] for link in links)
            yield n_a, n_b, len(groups), len(links), best, sum(count[link] for link in links), sha256(";".join(groups).encode()).hexdigest()


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@given(st.lists(st.integers(1, 3), min_size=1, max_size=40), st.lists(st.integers(1, 9), min_size=1, max_size=40))
@settings(max_examples=300, deadline=None)
def test_galloping_finds_what_a_scan_finds(a, b):
    a, b = np.cumsum(a), np.cumsum(b)
    short, long = sorted((np.append(a[a < min(a[-1], b[-1])], min(a[-1], b[-1])), np.append(b[b < min(a[-1], b[-1])], min(a[-1], b[-1]))), key=len)
    assert alignment.gallop(short, long).tolist() == [next(i for i, y in enumerate(long) if y >= x) for x in short]
    assert alignment.gallop(long, short).tolist() == [next(i for i, y in enumerate(short) if y >= x) for x in long]


TEXTS = [
    "Plain words, and some more.", "<|endoftext|> is text </s><s><unk> [INST]", "  two  spaces \n\n\ttabs ", "a▁b", "naïve Éèç ß ÿ ɏ ɐ",
    "漢字かな 🙂🙂 ́x", "<0x41> 1234567 don't we'll", "x", " ", "\n", "a\x00b", "ﬁ ½ ²", "​ Ꟛ\U0001f9ff", "é ẞ",
]


def test_ids_are_the_stated_tokenizers(plain):
    aligner = alignment.Aligner(*PATHS)
    for text in [*TEXTS, "w" * 3000, " " * 3000, "a b " * 2000, "\t \n" * 2000, "ab1-é" * 5000, "123" * 999]:
        a, b = plain(text)
        assert aligner.sides[0].ids(" " + text).tolist() == [i for i, _ in a]
        assert aligner.sides[1].ids(text) == [i for i, _ in b]
        assert [aligner.sides[0].bytes[i] for i, _ in a] == [t for _, t in a]


@given(st.text(st.characters(max_codepoint=0x24F), max_size=60))
@settings(max_examples=300, deadline=None)
def test_the_fast_way_gives_the_same_ids(text):
    if not hasattr(test_the_fast_way_gives_the_same_ids, "sides"):
        from tokenizers import Tokenizer

        stated = Tokenizer.from_file(PATHS[0])
        stated.encode_special_tokens = True
        test_the_fast_way_gives_the_same_ids.sides = alignment.ByteTokens(PATHS[0]), stated
    fast, stated = test_the_fast_way_gives_the_same_ids.sides
    assert fast.ids(text).tolist() == stated.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("part_pairs", [7, alignment.PART_PAIRS])
def test_edge_cases(spark, monkeypatch, make_docs, no_docs, plain, part_pairs):
    """Whatever the number of tables; repeated rows, null ids and texts, a long text, an extra column named as a result."""
    monkeypatch.setattr(alignment, "PART_PAIRS", part_pairs)
    texts = ["one two", "one two", "one, two three", None, "", "a▁b"] if part_pairs == 7 else [*TEXTS, *TEXTS[:4], None, "", "tail it is " * 3_000, None]
    docs = make_docs([(None if i % 5 == 0 else i // 2, t, "en", "s") for i, t in enumerate(texts)], extra="n_a")
    found = alignment.link_counts(spark, docs, *PATHS).collect()
    expected = [(i if i is None else i, *row) for i, row in zip([r["doc_id"] for r in docs.collect()], plain_counts(texts, plain))]
    assert sorted([(r["row"]["doc_id"], *(r[n] for n in NAMES)) for r in found], key=str) == sorted(expected, key=str)
    assert all(r["row"]["n_a"] == "x" for r in found)
    assert alignment.link_counts(spark, no_docs, *PATHS).collect() == []


def test_groups_give_the_text_back(spark, make_docs, plain):
    docs = make_docs([(i, t, "en", "s") for i, t in enumerate(TEXTS)])
    for r in alignment.groups(docs, *PATHS).collect():
        expected = plain_alignment(r["row"]["text"], plain)
        if expected is None:
            assert r["a"] == r["b"] == r["a_cuts"] == r["b_cuts"] == []
            continue
        cuts = [[0, *r["a_cuts"]], [0, *r["b_cuts"]]]
        parts = [[",".join(map(str, r[side][i:j])) for i, j in zip(c, c[1:])] for side, c in zip("ab", cuts)]
        assert ["|".join(p) for p in zip(*parts)] == expected[2]


def test_query_matches_brute_force(spark, sf_dir, tables, plain):
    docs = tables("documents")
    found = {r["doc_id"]: r for r in QUERIES["op12_alignment"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for d, expected in zip(docs, plain_counts([d["text"] for d in docs], plain)):
        assert tuple(found[d["doc_id"]][n] for n in NAMES) == expected
