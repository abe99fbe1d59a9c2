"""Operators against brute force, exact round trips, the libraries, or held-out accuracy."""

import collections
import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parity import connect, differences  # noqa: E402
from wearline.llm import (  # noqa: E402
    bitpack, components, context_tree, deobfuscate, fuzzy_lines, lsh_forest, multiset_hash, pieces, preference, queries,
    tiling, tokenhash, warc,
)
from wearline.llm.queries import vocabulary_file  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()


def classes_of(count, linked):
    """Least member of each item's component, from pairs."""
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return [find(x) for x in range(count)]


def similar(sets, threshold=0.8):
    owners = collections.defaultdict(list)
    for k, items in enumerate(sets):
        shared = collections.Counter(j for x in items for j in owners[x])
        for j, n in shared.items():
            if n / (len(items) + len(sets[j]) - n) >= threshold:
                yield j, k
        for x in items:
            owners[x].append(k)


# --- helpers -----------------------------------------------------------------


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab c\n", max_size=9), max_size=30))
def test_token_hashes(parts):
    data = "".join(parts).encode()
    members = tokenhash.byte_class(b"abc")
    found, at = tokenhash.token_hashes(data, members)
    words = [w for line in data.split(b"\n") for w in line.split(b" ") if w]
    assert len(found) == len(words)
    assert all((found[i] == found[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(i))
    assert all(data[a : a + len(w)] == w for a, w in zip(at, words))


def test_token_hashes_across_windows(monkeypatch):
    monkeypatch.setattr(tokenhash, "WINDOW", 16)
    members = tokenhash.byte_class(b"ab")
    data = b"ab " * 20 + b"a" * 50 + b" ab"
    found, _ = tokenhash.token_hashes(data, members)
    assert len(found) == 22 and len(set(found)) == 2


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    expected = classes_of(200, pairs)
    assert found == {k: expected[k] for p in pairs if p[0] != p[1] for k in p}


# --- 1 -----------------------------------------------------------------------


def test_archive_links(spark):
    schema = "record_id string, record_type string, date string, target_uri string, concurrent_to array<string>, block binary"
    rows = [
        ("r1", "response", "d", "u", [], b"1"), ("q1", "request", "d", "u", ["r1"], b"2"),
        ("m1", "metadata", "d", "u", ["q1"], b"3"), ("q2", "request", "d", "v", [], b"4"),
        ("r2", "revisit", "d", "v", ["q2"], b"5"), ("m9", "metadata", "d", "w", ["lost"], b"6"),
        ("i", "warcinfo", "d", None, [], b"7"),
    ]
    found = {r["capture_id"]: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {"r1", "r2", "m9"}
    assert [x["record_id"] for x in found["r1"]["requests"]] == ["q1"]
    assert [x["record_id"] for x in found["r1"]["metadata"]] == ["m1"]
    assert [x["record_id"] for x in found["r2"]["requests"]] == ["q2"]
    assert found["m9"]["response"] is None


def test_records_survive_small_splits(spark, folder):
    """A file without compression is read in many parts."""
    pages = spark.range(40).select(
        F.col("id").alias("page_id"), F.lit("http://a").alias("url"), F.repeat(F.lit("ab\r\n\r\n"), 20).alias("html")
    )
    warc.records(pages).coalesce(1).write.option("lineSep", warc.RECORD_END).text(folder + "/a")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        found = warc.read_records(spark, folder + "/a")
        assert found.rdd.getNumPartitions() > 20
        assert found.count() == 120 and found.filter("complete").count() == 120
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- 2 -----------------------------------------------------------------------


def brute_tree(texts, depth):
    """Context-tree weighting by its definition, in dictionaries."""
    counts = collections.defaultdict(lambda: [0, 0])

    def path(data, i):
        for bit in range(8):
            yield (1 << bit) | (data[i] >> (8 - bit)), (data[i] >> (7 - bit)) & 1

    for data in texts:
        padded = bytes(depth) + data
        for i in range(depth, len(padded)):
            for node, value in path(padded, i):
                for d in range(depth + 1):
                    counts[padded[i - d : i], node][value] += 1

    def own(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    block = {}
    for d in range(depth, -1, -1):
        children = collections.defaultdict(float)
        for (context, node), value in block.items():
            if len(context) == d + 1:
                children[context[1:], node] += value
        for (context, node), n in counts.items():
            if len(context) == d:
                mine = own(n)
                block[context, node] = (
                    mine if d == depth else np.logaddexp(math.log(0.5) + mine, math.log(0.5) + children[context, node])
                )

    def score(data):
        padded, total = bytes(depth) + data, 0.0
        for i in range(depth, len(padded)):
            for node, value in path(padded, i):
                p = 0.5
                for d in range(depth, -1, -1):
                    n = counts.get((padded[i - d : i], node))
                    if n is None:
                        continue
                    estimate = (n[value] + 0.5) / (sum(n) + 1)
                    deeper = d < depth and (padded[i - d - 1 : i], node) in counts
                    w = math.exp(math.log(0.5) + own(n) - block[padded[i - d : i], node]) if d < depth else 1.0
                    p = w * estimate + (1 - w) * p if deeper else estimate
                total += math.log10(p)
        return total

    return score


def test_context_tree(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["the ", "then ", "a", "b ", "é", "\n"]) for _ in range(40)) for _ in range(16)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in context_tree.scores(table, part_bytes=100).collect()}
    held = [zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))]
    assert any(held) and [rows[k]["held_out"] for k in range(len(texts))] == held
    data = [b" ".join(t.encode().lower().split()) + b"\n" for t in texts]
    score = brute_tree([d for d, h in zip(data, held) if not h], context_tree.DEPTH)
    words = [d.split() + ["end"] for d in data]
    counts = collections.Counter(w for ws, h in zip(words, held) if not h for w in ws)
    total = sum(counts.values())
    for k in range(len(texts)):
        assert rows[k]["score"] == pytest.approx(score(data[k]), rel=1e-5)
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words[k])
        assert rows[k]["base_score"] == pytest.approx(base, rel=1e-9)
        assert rows[k]["n_known"] == sum(counts[w] > 0 for w in words[k])
        assert (rows[k]["n_tokens"], rows[k]["train_tokens"]) == (len(words[k]), total)


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.5, 100.0, 12345.5])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def test_probabilities_of_all_bytes_sum_to_one():
    keys, n = np.unique(context_tree.grams(b"abracadabra abra\n", np.array([17])), return_counts=True)
    tree = context_tree.levels(keys, n, 0, context_tree.DEPTH)
    for context in (0, int.from_bytes(b" abra", "big"), int.from_bytes(b"zzzzz", "big")):
        every = (np.int64(context) << 8) | np.arange(256)
        assert (10 ** context_tree.log_probabilities(every, tree)).sum() == pytest.approx(1.0)


# --- 3 and 9 -----------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"block_texts": 3}])
def test_forest_equals_brute_force(spark, documents, limits):
    rng = random.Random(9)
    words = [rng.choice("abcdefghij") + str(rng.randrange(99)) for _ in range(120)]
    texts = [d["text"] for d in documents[:60]]
    for _ in range(12):  # one group of variants, larger than a block
        edited = list(words)
        edited[rng.randrange(120)] = "changed"
        texts.append(" ".join(edited))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in lsh_forest.classes(table, **limits).collect()}
    sets = []
    for text in texts:
        w = text.lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    pairs = list(similar(sets))
    expected = classes_of(len(texts), pairs)
    links = [set() for _ in texts]
    for a, b in pairs:
        if sets[a] != sets[b]:
            links[a].add(sets[b])
            links[b].add(sets[a])
    assert [found[k]["class_id"] for k in range(len(texts))] == expected
    assert [found[k]["n_links"] for k in range(len(texts))] == [len(x) for x in links]


def test_texts_of_clusters_move_the_same_way_at_any_size(spark):
    """Few clustered texts are joined by exchange too, and each text comes once."""
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, "c")], "doc_id long, text string")
    copies = docs.filter("doc_id < 4").selectExpr("xxhash64(coalesce(text, '')) AS copy")
    found = lsh_forest._texts_of(docs, copies)
    assert sorted(r["text"] for r in found.collect()) == ["", "a b"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_prefix_is_shortened_to_the_target():
    length = lsh_forest.prefix_length(0.8, 20, 8, 0.999)
    assert lsh_forest.recall(length, 20, 0.8) >= 0.999 > lsh_forest.recall(length + 1, 20, 0.8)


def test_lines_equal_brute_force(spark, documents):
    rng = random.Random(6)
    base = "the quick brown fox jumps over the lazy dog and runs away from it very quickly today"
    extra = []
    for k in range(40):  # variants of one line
        at = rng.randrange(len(base) - 3)
        extra.append(base[:at] + "%02d" % k + base[at + 2 :])
    texts = [d["text"] for d in documents[:80]] + extra
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = fuzzy_lines.judged(fuzzy_lines.line_classes(table)).collect()
    places = {
        (d, k): line.strip() for d, t in enumerate(texts) for k, line in enumerate(t.split("\n")) if line.strip()
    }
    lines = list(dict.fromkeys(places.values()))
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in lines]
    classes = classes_of(len(lines), similar(sets))
    number = {x: classes[k] for k, x in enumerate(lines)}
    first = {}
    for place in sorted(places):
        first.setdefault(number[places[place]], place)
    expected = {p: first[number[x]] == p for p, x in places.items()}
    assert {(r["doc_id"], r["line_no"]): r["kept"] for r in found} == expected


# --- 4 -----------------------------------------------------------------------


def test_restoration(documents):
    model = deobfuscate.letter_model(deobfuscate.trigram_counts([d["text"] for d in documents] + ["idiot moron trash"] * 20))
    reader = deobfuscate.Reader(model, {f: 3.0 for w in ("idiot", "moron", "trash") for f in deobfuscate.features(w)})
    for text in ("1d10t", "m0r0n!", "tr@sh", "idiooooot", "i d i o t", "m-o-r-o-n", "TRAAASH"):
        assert reader.total(text) == 3.0, text
    assert reader.total("the plain words of a clean text, 4.0 and $5") == 0.0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op4_deobfuscated_toxicity(spark, folder)
    joined = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in joined)
    assert right / len(joined) > 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in joined)


# --- 5 -----------------------------------------------------------------------


def test_preference_sql(spark):
    name = "op5_preference_pairs"
    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE_SQL[name]) == ""


def test_longest_common_prefix(spark):
    schema = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "good")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "less")]
    (row,) = preference.format_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()
    assert row["n_common"] == 2 and row["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n"
    (span,) = row["chosen_spans"]
    assert row["chosen"][span["start"] : span["end"]] == "good<|end|>\n" and row["rejected_spans"] == []


# --- 6 and 7 -----------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(0, 2**w - 1), max_size=60))))
def test_bits(case):
    width, ids = case
    data = bitpack.write_block([7], [np.array(ids, np.uint32)], width)
    _, offsets, part = bitpack.read_block(data)
    assert part(0, int(offsets[-1])).tolist() == ids
    middle = len(ids) // 2
    assert part(middle, len(ids)).tolist() == ids[middle:]


def test_encoder_equals_the_library(documents):
    from tokenizers import Tokenizer

    path = vocabulary_file("word_bpe_49k.json")
    texts = [d["text"] for d in documents] + ["It's  A B", "ΟΔΟΣ", "İ<|endoftext|> x", "éÅ\ttab\x0b1234"]
    library = Tokenizer.from_file(path)
    own = bitpack.Encoder(path)
    for text in texts:
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoder_works_out_a_word_once():
    """Texts of known words ask for no pre-token again; rare blanks, signs and marks still give the library's ids."""
    from tokenizers import Tokenizer

    path = vocabulary_file("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bitpack.Encoder(path)
    odd = [f"one{blank}two, it's" for blank in "\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2028\u3000"]
    odd += ["", " ", ",", ".,", "...,a.", "a,.", "It's. 'S 's, don't", "Élan, ªº \r\n e\u0301.", "a1, 1a.", "<|x ab<|endoftext|>", "ŉ, ǅ."]
    for text in odd + odd:
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids
    first, asked = own("Some words, that it's full of.\nAgain").tolist(), []
    whole = own.split
    own.split = lambda text: asked.append(text) or whole(text)
    again = own("Again full of. it's words, that").tolist()
    assert first and again and not asked


def test_encoder_keeps_common_words():
    """However many other words pass, a word of every text is worked out once and no more than the bound stays."""
    from tokenizers import Tokenizer

    path = vocabulary_file("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bitpack.Encoder(path, remembered=60)
    find, asked = own.words.find, []
    own.words.find = lambda part: asked.append(part) or find(part)
    for k in range(100):
        text = f"the {'abcdefghij'[k % 10] * (k // 10 + 3)}, Word{k} \u023a"[: None if k % 7 else -2]
        assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.words) + len(own.words.older) <= 60
    assert asked.count("the") == 1 and len(asked) > 100


def test_packed_ids(spark):
    rows = queries.op6_bit_packing(spark, SMALL).orderBy("doc_id").collect()
    own = bitpack.Encoder(vocabulary_file("word_bpe_49k.json"))
    start = 0
    for row, doc in zip(rows, spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()):
        ids = np.append(own(doc["text"]), 2).astype("<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc["doc_id"], start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_pieces_keep_common_words():
    """However many other words pass, a word of every text is segmented once and no more than the bound stays."""
    path = vocabulary_file("piece_bpe_32k.model")
    own, whole = pieces.Pieces(path, remembered=60), pieces.Pieces(path)
    segment, asked = own.segment, []
    own.segment = lambda words: asked.extend(words) or segment(words)
    for k in range(100):
        text = f"the {'abcdefghij'[k % 10] * (k // 10 + 3)}, word{k}"
        assert own.encode([text])[0].tolist() == whole.encode([text])[0].tolist()
        assert len(own.words) + len(own.older) <= 60
    assert asked.count("▁the") == 1 and len(asked) > 100


def test_viterbi_is_optimal(documents):
    from sentencepiece import sentencepiece_model_pb2 as proto

    path = vocabulary_file("piece_bpe_32k.model")
    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    score = {p.piece: p.score for p in model.pieces if p.type == pieces.NORMAL}
    own = pieces.Pieces(path)
    words = list({w for d in documents[:40] for w in own.split(d["text"])})[:2000] + ["▁日本x", "▁▁▁", "▁" + "ab" * 400]
    for word, ids in zip(words, own.segment(words)):
        best = [0.0]
        for end in range(1, len(word) + 1):
            best.append(
                max(
                    best[end - n] + score.get(word[end - n : end], own.unknown_score if n == 1 else -math.inf)
                    for n in range(1, min(end, 16) + 1)
                )
            )
        got, spelled = 0.0, b""
        for k in ids:
            piece = model.pieces[k]
            got += piece.score if piece.type == pieces.NORMAL else 0.0
            spelled += own.plain[k]
        unknown = sum(c not in score for c in word)
        assert got + unknown * own.unknown_score == pytest.approx(best[-1])
        assert spelled.decode() == word.replace("▁", " ")


# --- 8 -----------------------------------------------------------------------


def brute_tiles(doc, item, least):
    """Greedy string tiling as first published: all maximal matches, longest first."""
    a, b, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        if best[0] < least:
            return tiles
        n, j, i = best
        for k in range(n):
            a[i + k] = b[j + k] = True
        tiles.append(best)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), min_size=1, max_size=25), st.integers(1, 4))
def test_tiles(doc, item, least):
    own = tiling.tile(np.array(doc, np.int64), np.array(item, np.int64), least)
    expected = brute_tiles(doc, item, max(1, min(least, len(item))))
    assert [t[0] for t in own][:1] == [t[0] for t in expected][:1]
    marked = set()
    for n, j, i in own:
        assert doc[i : i + n] == item[j : j + n]
        assert not marked & {("d", i + k) for k in range(n)} and not marked & {("i", j + k) for k in range(n)}
        marked |= {("d", i + k) for k in range(n)} | {("i", j + k) for k in range(n)}


def test_reordered_passages_are_found(spark):
    rng = random.Random(1)
    words = [f"word{rng.randrange(10_000)}" for _ in range(40)]
    moved = words[20:] + ["filler"] + words[:20]
    near = [w if k % 3 else "other" for k, w in enumerate(words)]
    docs = [(1, "before " + " ".join(moved).upper() + ", after"), (2, " ".join(near)), (3, " ".join(words[:15]))]
    found = tiling.tiled_pairs(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(9, " ".join(words))], "item_id long, text string"),
    ).collect()
    assert [(r["doc_id"], r["item_id"], r["coverage"], len(r["tiles"])) for r in found] == [(1, 9, 1.0, 2)]
    sliced = tiling.tiled_pairs(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(words)) for k in range(5)], "item_id long, text string"),
        slice_chars=300,
    )
    assert sliced.count() == 5


# --- 10 ----------------------------------------------------------------------


def test_fingerprints_by_definition(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op10_multiset_fingerprint(spark, SMALL).collect()}
    texts = [d["text"] for d in documents]
    for k, doc in enumerate(documents):
        row, text, after = rows[doc["doc_id"]], texts[k], texts[(k + 1) % len(texts)]
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        for column, own in (("fingerprint", text), ("edited_fingerprint", changed)):
            lanes = np.zeros(16, np.uint64)
            for paragraph in filter(None, own.split("\n")):
                lanes += np.frombuffer(hashlib.sha512(paragraph.encode()).digest(), ">u4").astype(np.uint64)
            assert row[column][:128] == "".join("%08x" % (int(x) % 2**32) for x in lanes)


def test_fingerprints_add_up(spark):
    table = spark.createDataFrame([("a b c d\ne f g", "e f g\na b c d", "a b c d", "e f g")], "x string, y string, p string, q string")
    lanes = {c: multiset_hash.exact_lanes(F.col(c)) for c in "xypq"}
    bits = multiset_hash.EXACT_BITS
    row = table.select(
        lanes["x"].alias("x"), lanes["y"].alias("y"), lanes["p"].alias("p"),
        multiset_hash.plus(lanes["p"], lanes["q"], bits).alias("sum"),
        multiset_hash.minus(lanes["x"], lanes["q"], bits).alias("rest"),
    ).first()
    assert row["x"] == row["y"] == row["sum"] and row["rest"] == row["p"]


def test_order_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(multiset_hash, "SINGLE", 3)
    monkeypatch.setattr(multiset_hash, "SPAN", 4)
    keys = sorted({-(2**60), -5, -1, 0, 1, 2, 3, 9, 10, 500, 10**6, 2**50})
    found = multiset_hash.successors(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert dict(map(tuple, found.collect())) == dict(zip(keys, [*keys[1:], None]))
