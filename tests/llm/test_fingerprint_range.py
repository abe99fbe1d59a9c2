"""Likeness of long, repetitive texts."""

from wearline.llm import multiset_hash


def test_likeness_of_long_repetitive_texts(spark):
    rows = [(1, "\n".join(["a b c"] * 40_000)), (2, "\n".join(["a b c"] * 20_000)), (3, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in multiset_hash.fingerprints(docs).collect()}
    assert found[1]["near_edited"] > 0.99 and found[1]["near_next"] > 0.99
    assert all(len(r["fingerprint"]) == 1152 for r in found.values())
