"""Phrase collocations against brute force, and their edge cases."""

import re
from collections import Counter

from wearline.llm import collocations

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n long, w1 string, phrase string, bucket long"


def brute(rows, least, share=100, first=2_000):
    found = {}
    for lang in {lang or "und" for _, lang in rows}:
        counts, n = Counter(), 0
        for text, its in rows:
            if (its or "und") != lang:
                continue
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LETTERS)):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                counts.update(tuple(words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + m]
            for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= share * candidates[p[i : i + m]]
        }
        kept = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = ((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], 1):
            found[lang, rank] = (phrase.decode(), -a, left, right, n, -score)
    return found


def result(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, g, 1, "w", "p", 2) for k, (t, g) in enumerate(rows)], SCHEMA).repartition(3)
    shown = collocations.collocations(docs, **options).collect()
    return {(r["lang"], r["rank"]): tuple(r[2:]) for r in shown}


ROWS = [
    ("The cat sat, the CAT sat! a b c d e f a b c d e f", "en"),
    ("the cat sat. the cat ran; The cat\nsat", "en"),
    ("x x x x x x x x", None),
    ("x x x", "und"),
    ("É é É é. Ä ä", "fr"),
    ("\t tab\ttab \u00a0 tab\ttab\u00a0", "fr"),
    (None, "en"), ("", "de"), ("...,,;", None), ("a b\x0ba b\x0ca b\ra b", "en"),
]


def test_equals_brute_force(spark):
    for options in ({"least": 2}, {"least": 3}, {"least": 2, "share": 60}, {"least": 2, "first": 3}):
        found = result(spark, ROWS, **options)
        assert found == brute(ROWS, **options) and len(found) > 3


def test_buckets_and_blocks_change_nothing(spark):
    """Every word in a few buckets, and texts cut into blocks of some bytes."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").collect()
    rows = [(r["text"], r["lang"]) for r in rows if len(r["text"]) < 3_000]
    wanted = brute(rows, 8)
    assert len(wanted) > 20
    for options in ({}, {"bits": 16, "block": 500}, {"bits": 3}):
        assert result(spark, rows, least=8, **options) == wanted


def test_ranking_in_parts_is_exact(spark, monkeypatch):
    wanted = result(spark, ROWS, least=2, first=2)
    monkeypatch.setattr(collocations, "RANKED", 4)
    assert result(spark, ROWS, least=2, first=2) == wanted


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", 1, "a", 9 * 10**12), ("en", 1, "b", 8 * 10**12), ("en", 2, "a b", 7 * 10**12)],
        "lang string, size int, phrase string, f long",
    )
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    row = collocations.scored(phrases, totals).first()
    assert row["score"] == 1000 * 7 * 10**12 * 10**13 // (72 * 10**24)


def test_no_rows(spark):
    assert result(spark, []) == {}
    assert result(spark, ROWS, least=1_000) == {}
