"""Likeness lanes against brute force, and likenesses from the returned fingerprints alone."""

import math

import pytest
import xxhash

from wearline.llm import multiset_hash, queries

SMALL = "/root/testdata/sf0.001"


def lanes_by_hand(text):
    """Sums of signs per lane of all runs of three words."""
    lanes = [0] * 128
    for paragraph in filter(None, text.split("\n")):
        words = paragraph.split(" ")
        for run in [words[i : i + 3] for i in range(len(words) - 2)] or [words]:
            h = 42
            for word in run:
                h = xxhash.xxh64(word.encode(), seed=h).intdigest()
            lanes[h % 128] += -1 if h >> 40 & 1 else 1
    return lanes


def lanes_of(fingerprint):
    shown = [int(fingerprint[128 + 8 * k : 136 + 8 * k], 16) for k in range(128)]
    return [x - 2**32 if x >= 2**31 else x for x in shown]


def cosine(a, b):
    size = math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    return min(1.0, max(0.0, sum(x * y for x, y in zip(a, b)) / size)) if size else float(a == b)


def test_likeness_is_of_the_returned_fingerprints(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    rows = queries.op10_multiset_fingerprint(spark, SMALL).orderBy("doc_id").collect()
    for k, row in enumerate(rows):
        own, edited = lanes_of(row["fingerprint"]), lanes_of(row["edited_fingerprint"])
        if k % 10 == 0:
            assert own == lanes_by_hand(texts[k])
        assert row["near_edited"] == pytest.approx(cosine(own, edited), abs=1e-9)
        assert row["near_next"] == pytest.approx(cosine(own, lanes_of(rows[(k + 1) % len(rows)]["fingerprint"])), abs=1e-9)


def test_long_repetitive_texts_and_likeness_of_strings(spark):
    rows = [(1, "\n".join(["a b c"] * 40_000)), (2, "\n".join(["a b c"] * 20_000)), (3, "d e f")]
    found = multiset_hash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    shown = found.withColumn("again", multiset_hash.likeness_of(found["fingerprint"], found["edited_fingerprint"]))
    for row in shown.collect():
        assert row["again"] == row["near_edited"]
        assert row["near_edited"] == pytest.approx(cosine(lanes_of(row["fingerprint"]), lanes_of(row["edited_fingerprint"])))


def test_heads_of_blocks_are_looked_up_or_joined(spark, monkeypatch):
    rows = [(k * 37 if k % 5 else None, f"text {k % 7}\nline {k}") for k in range(60)] + [(0, "b"), (0, "a"), (0, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    first = sorted(map(tuple, multiset_hash.with_next(docs).collect()), key=str)
    monkeypatch.setattr(multiset_hash, "SENT_FIRSTS", 0)
    assert sorted(map(tuple, multiset_hash.with_next(docs).collect()), key=str) == first
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    wanted = sorted((r[1], order[(k + 1) % len(order)][1]) for k, r in enumerate(order))
    assert sorted((r[3], r[4]) for r in first) == wanted
