"""Token alignments against brute force over bytes, and tokens against the libraries."""

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wearline.llm import token_alignment
from wearline.llm.queries import vocabulary_file

FILES = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row long, pair int, n long, groups string, a long"
ODD = [
    None, "", " ", "a", " a", "a ", "a  b", "a \n b", "a\n\n b\t c", "\u2581", "a\u2581b", "<|endoftext|> hi", "<s> <unk> <0x41>",
    "\x00 a", "\uff41\uff42 c", "e\u0301 caf\u00e9", "\u00a0x", "\U0001f642\u200d\U0001f469 abc", "\u65e5\u672c\u8a9e text", "x" * 500,
    "don't we'll I'M", "12 345 6789", "the cat the cat the cat",
]


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(token_alignment.ByteLevel(FILES[0]), token_alignment.PieceModel(FILES[1]))


def spans(tokens):
    at, found = 0, []
    for token in tokens:
        found.append((at, at + len(token)))
        at += len(token)
    return found


def brute(aligner, text):
    """Groups as text, and links with how often they occur, from byte ranges alone."""
    if not text:
        return 0, 0, "", Counter()
    a = aligner.a.library.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    tokens = [aligner.a.bytes[k] for k in a], [aligner.b.bytes[k] for k in b]
    if any(b"".join(t) != (" " + text).encode() for t in tokens):
        return 0, 0, "", Counter()
    of_a, of_b = map(spans, tokens)
    ends, groups, start = sorted({y for _, y in of_a} & {y for _, y in of_b}), [], 0
    for end in ends:
        sides = ([str(k) for k, (x, y) in zip(ids, of) if start <= x and y <= end] for ids, of in ((a, of_a), (b, of_b)))
        groups.append("|".join(map(",".join, sides)))
        start = end
    links = Counter((i, j) for i, (x, y) in zip(a, of_a) for j, (u, v) in zip(b, of_b) if max(x, u) < min(y, v))
    return len(a), len(b), ";".join(groups), links


def coded(aligner, links):
    return {i * aligner.b.size + j: n for (i, j), n in links.items()}


def same(aligner, text):
    n_a, n_b, groups, pairs, times = aligner(text)
    wanted = brute(aligner, text)
    return (n_a, n_b, groups, dict(zip(pairs.tolist(), times.tolist()))) == (*wanted[:3], coded(aligner, wanted[3]))


def test_odd_texts(aligner):
    assert all(same(aligner, text) for text in ODD)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab e'st1.,\n\t \u00e9\u00df\u2581\u00a0\u65e5\U0001f642<|>"), max_size=40))
def test_any_text(aligner, text):
    assert same(aligner, text)


def test_words_have_the_windows_of_their_text(spark, aligner):
    """Tokens and windows of words are those of whole texts, which the libraries encode."""
    plain = 0
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        if token_alignment._is_plain(r["text"]):
            plain += 1
            assert aligner._of_words(r["text"].split(" ")) == aligner._of_tokens(r["text"])
    assert plain > 100


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab e's\"t1.,\n-\u00e9\u00df'"), min_size=1, max_size=30))
def test_words_of_any_plain_text(aligner, text):
    if token_alignment._is_plain(text):
        a = aligner.a.library.encode(" " + text, add_special_tokens=False).ids
        assert a == aligner.a.fast.encode_ordinary(" " + text)
        words = aligner._of_words(text.split(" "))
        assert words is None or words == aligner._of_tokens(text)


def test_forgetting_changes_nothing(aligner):
    small = token_alignment.Aligner(aligner.a, aligner.b, memo_bytes=500)
    assert all(same(small, text) for text in ODD + ODD)


def test_a_long_text_without_spaces(aligner):
    assert same(aligner, "ab9" * 1_500)
    n_a, n_b, groups, _, times = aligner("abcdefg1" * 40_000)
    assert times.sum() == n_a + n_b - groups.count(";") - 1


def expected(aligner, texts):
    found = [brute(aligner, t) for t in texts]
    counts = Counter(pair for f in found for pair in f[3])
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for k, (n_a, n_b, groups, links) in enumerate(found):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        yield (
            n_a, n_b, groups.count(";") + bool(groups), sum(links.values()),
            sum(n for p, n in links.items() if counts[p] == most[p[0]]),
            sum(n * counts[p] for p, n in links.items()), digest,
        )


@pytest.mark.parametrize("sent", [token_alignment.SENT_PAIRS, 0])
def test_counts_over_documents(spark, aligner, sent, monkeypatch):
    scored = token_alignment.with_counts
    monkeypatch.setattr(token_alignment, "with_counts", lambda rows, counts: scored(rows, counts, sent))
    texts = ODD + ["the cat sat", "the cat", "the cat", "cats the"]
    rows = [(None if k == 4 else k // 2, t, 1, 2, 3, "g", 4) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = sorted((tuple(r) for r in token_alignment.link_scores(docs, *FILES).select(columns).collect()), key=str)
    wanted = sorted(((r[0], *e) for r, e in zip(rows, expected(aligner, texts))), key=str)
    assert found == wanted


def test_no_documents(spark):
    assert token_alignment.link_scores(spark.createDataFrame([], SCHEMA), *FILES).isEmpty()
