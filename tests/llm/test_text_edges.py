"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wearline.llm import (
    bitpack, context_tree, deobfuscate, fuzzy_lines, lsh_forest, multiset_hash, pieces, preference, tiling, warc,
)
from wearline.llm.queries import vocabulary_file

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " h long, name string, block int, keys string, batch long, value string"
)
LONG = " ".join(f"w{k % 977}x{k}" for k in range(20_000))
TEXTS = [
    (1, None), (2, ""), (3, "   \n\n "), (4, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"),
    (None, "gamma delta epsilon zeta eta theta"), (6, LONG), (7, "é́ ñandú ▁ 日本 \U0001f600 end"),
    (8, "x" * 5000), (9, "one line\none line\r\none line"), (10, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None, 1, "n", 2, "k", 3, "v") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 0, 0), (4, 1, 1), (None, 1, 1), (6, None, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "gamma delta"), (3, "alpha")], "item_id long, text string")


def ids(df):
    return sorted(str(r["doc_id"]) for r in df.collect())


ALL = sorted(str(i) for i, _ in TEXTS)


def test_packing(spark, odd, none, folder):
    for k, docs in enumerate((odd, none)):
        bitpack.write_ids(docs, f"{folder}/{k}", vocabulary_file("word_bpe_49k.json"), 49_408, 2, block_ids=50)
    read = bitpack.read_ids(spark, f"{folder}/0").orderBy("start").collect()
    assert [r["doc_id"] for r in read][:3] == [None, 1, 2] and len(read) == len(TEXTS)
    assert [r["start"] for r in read] == [sum(x["n_tokens"] for x in read[:k]) for k in range(len(read))]
    assert all(r["n_tokens"] == 1 for r in read if r["doc_id"] in (1, 2, 10))
    assert bitpack.read_ids(spark, f"{folder}/1").isEmpty()
    few = bitpack.read_ids(spark, f"{folder}/0", [6, 4]).collect()
    whole = {r["doc_id"]: bytes(r["ids"]) for r in read}
    assert {r["doc_id"]: bytes(r["ids"]) for r in few} == {k: whole[k] for k in (4, 6)}


def test_pieces(odd, none):
    path = vocabulary_file("piece_bpe_32k.model")
    coded = odd.withColumn("piece_ids", pieces.encode_column(path)).withColumn("back", pieces.decode_column(path))
    for row in coded.collect():
        assert row["back"] == (row["text"] or "").replace("▁", " ")
    assert none.withColumn("piece_ids", pieces.encode_column(path)).isEmpty()


def test_tiling(odd, none, benchmark):
    found = tiling.tiled_pairs(odd, benchmark).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["coverage"]) for r in found) == [
        ("4", 3, 1.0), ("5", 3, 1.0), ("5", 3, 1.0), ("None", None, 1.0),
    ]
    assert ids(tiling.decontaminate(odd, benchmark)) == sorted(i for i in ALL if i not in ("4", "5", "None"))
    assert tiling.tiled_pairs(none, benchmark).isEmpty()
    assert tiling.tiled_pairs(odd, benchmark.limit(0)).isEmpty()


def test_toxicity(odd, none, labels):
    model = deobfuscate.fit(odd, labels)
    scored = deobfuscate.score(odd, model)
    assert ids(scored) == ALL
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored.collect())
    empty = deobfuscate.fit(none, labels.limit(0))
    assert deobfuscate.score(none, empty).isEmpty() and deobfuscate.clean(odd, empty).columns == odd.columns


def test_lines(odd, none):
    judged = fuzzy_lines.judged(fuzzy_lines.line_classes(odd))
    kept = {(r["doc_id"], r["line_no"]) for r in judged.filter("kept").collect()}
    # Equal places of repeated rows are one place; white space around a line does not count.
    assert (4, 0) in kept and (5, 0) not in kept and {p for p in kept if p[0] == 9} == {(9, 0)}
    assert fuzzy_lines.judged(fuzzy_lines.line_classes(none)).isEmpty()
    left = fuzzy_lines.deduplicate(odd)
    assert left.columns == odd.columns and ids(left) == sorted(i for i in ALL if i != "5")


def test_forest(odd, none):
    found = lsh_forest.classes(odd).collect()
    by_id = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found}
    assert len(found) == len(TEXTS) and by_id[5] == (4, 0) and by_id[1] == (1, 0) and by_id[2] == (2, 0)
    assert by_id[None] == (None, 0)
    left = lsh_forest.deduplicate(odd)
    assert left.columns == odd.columns and ids(left) == sorted(i for i in ALL if i != "5")
    assert lsh_forest.classes(none).isEmpty()


def test_fingerprints(odd, none):
    rows = multiset_hash.fingerprints(odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ALL
    empty = {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 10)}
    assert empty == {"0" * 1152}
    assert multiset_hash.fingerprints(none).isEmpty()
    (single,) = multiset_hash.fingerprints(odd.filter("doc_id = 6")).collect()
    assert single["near_next"] == 1.0  # the document after the only one is itself


def test_language_model(odd, none):
    rows = context_tree.scores(odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ALL
    assert all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
    assert context_tree.scores(none).isEmpty()
    untrained = context_tree.scores(odd.filter("doc_id = 10 and crc32(cast(doc_id as string)) % 7 = 2"))
    assert all(r["n_known"] == 0 for r in untrained.collect())


def test_preferences(spark):
    schema = "conv_id long, turn long, role string, text string, pair_id int"
    rows = [
        (1, 0, "user", "hi", 7), (1, 1, "assistant", None, 7), (2, 0, None, "x", 7), (None, None, "user", "y", 7),
        (3, 0, "assistant", "a", 7), (3, 0, "assistant", "a", 7), (4, 0, "assistant", "b", 7),
    ]
    table = spark.createDataFrame(rows, schema).drop("pair_id")
    found = {r["pair_id"]: r for r in preference.format_pairs(*preference.replies_of_neighbours(table)).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    assert found[1]["chosen"] == found[1]["rejected"] == "" and found[1]["n_common"] == 2
    assert found[2]["prompt"] == "<|unknown|>\nx<|end|>\n"
    assert found[4]["chosen"] == "<|assistant|>\nb<|end|>\n" and found[4]["rejected"] == "<|assistant|>\n<|end|>\n"
    assert preference.format_pairs(*preference.replies_of_neighbours(table.limit(0))).isEmpty()


def test_archives(spark, folder):
    rows = [
        (1, "http://a/x", "<p>é</p>"), (2, None, None), (3, "http://b", ""), (4, "http://c", "<p>é</p>"),
        (5, "http://d", "a\r\n\r\nWARC/1.1\r\nb\r\n\r\nWARC/1.1\r\n\r\n\r\nWARC/1.1\r\nc"), (None, "http://e", "none"),
        (6, "http://f", "twin"), (6, "http://g", "other twin"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_archives(pages, folder + "/a")
    found = warc.with_payload(warc.read_records(spark, folder + "/a"))
    captures = warc.assemble(found).collect()
    assert len(captures) == len(rows)
    assert all(len(c["requests"]) == len(c["metadata"]) == 1 and c["response"]["complete"] for c in captures)
    responses = {c["response"]["target_uri"]: c["response"] for c in captures}
    assert bytes(responses["http://d"]["payload"]).decode() == rows[4][2]
    assert responses["http://a/x"]["record_type"] == "revisit" and responses["http://a/x"]["payload_bytes"] == 9
    assert responses["http://c"]["record_type"] == "response"
    warc.write_archives(pages.limit(0), folder + "/b")
    assert warc.assemble(warc.with_payload(warc.read_records(spark, folder + "/b"))).isEmpty()


def test_pipeline(spark, odd, labels, benchmark, folder):
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    for k, docs in enumerate((odd, odd.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            path = f"{folder}/{k}-{name}"
            stage(spark, docs, folder).write.parquet(path)
            after = spark.read.parquet(path)
            assert after.columns[: len(docs.columns)] == docs.columns
            docs = after
    assert F.col("piece_ids") is not None
