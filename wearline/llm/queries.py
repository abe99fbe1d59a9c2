"""Registered queries of the text operators: each over its whole table, with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import bitpack, collocations, context_tree, deobfuscate, fuzzy_lines, lsh_forest, multiset_hash, pieces, preference, tiling, token_alignment, url_filter, warc
from wearline.llm.collocations_sql import collocations_sql
from wearline.workspace import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last reply, as prompt and completions."""
    sides = preference.replies_of_neighbours(_table(spark, sf_dir, "conversations"))
    pairs = preference.format_pairs(*sides)

    def trained(spans: str) -> Column:
        sizes = F.transform(spans, lambda s: s["end"] - s["start"])
        return F.aggregate(sizes, F.lit(0), lambda total, n: total + n).cast("long")

    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        trained("chosen_spans").alias("chosen_trained"),
        trained("rejected_spans").alias("rejected_trained"),
    )


def op6_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed ids of all documents, read back from their blocks."""
    folder = new_folder(spark, "packed-ids")
    docs = _table(spark, sf_dir, "documents")
    bitpack.write_ids(docs, folder, vocabulary_file("word_bpe_49k.json"), 49_408, end_id=2)
    read = bitpack.read_ids(spark, folder)
    # The ids stay inside Spark's own checksum: no second pass in Python.
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC archives: written, read back, assembled to one row per capture."""
    folder = new_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    captures = warc.assemble(warc.with_payload(warc.read_records(spark, folder)))

    def page(identifier: str) -> Column:
        number = F.regexp_extract(identifier, "^<urn:page:capture:(-?[0-9]*)-[0-9A-Z.]+>$", 1)
        return F.when(number != "", number).cast("long")

    return captures.select(
        page("capture_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        # Of the payload as read back; a revisit has none and states that of its response.
        F.when(F.col("response.record_type") == "response", warc.sha1_base32(F.col("response.payload")))
        .otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        page("response.refers_to").alias("refers_to"),
        F.size("requests").alias("n_requests"),
        F.size("metadata").alias("n_metadata"),
    )


def op2_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under the training folds' context tree and word counts."""
    return context_tree.scores(_table(spark, sf_dir, "documents"))


def op3_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies and its number of linked texts."""
    return lsh_forest.classes(_table(spark, sf_dir, "documents"))


def op4_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = deobfuscate.fit(docs, _table(spark, sf_dir, "labels"))
    return deobfuscate.score(docs, model)


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces and back: counts, a checksum of the ids, and the comparison."""
    found = pieces.round_trip(vocabulary_file("piece_bpe_32k.model"))
    coded = _table(spark, sf_dir, "documents").select("doc_id", found.alias("p"))
    return coded.select(
        "doc_id",
        "p.n_pieces",
        "p.n_byte_pieces",
        F.crc32("p.ids").alias("ids_crc32"),
        "p.decoded_equal",
    )


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that contaminate them, with the covered share."""
    pairs = tiling.tiled_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return pairs.select(
        "doc_id", "item_id", "item_tokens", "covered_tokens", "coverage", F.size("tiles").alias("n_tiles")
    )


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its class, and whether it is the one of its class that stays."""
    return fuzzy_lines.judged(
        fuzzy_lines.line_classes(_table(spark, sf_dir, "documents"), size=fuzzy_lines.QUERY_SHINGLE)
    )


def op10_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    return multiset_hash.fingerprints(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language, from the marginals of all longest windows."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict, from cascades of Bloom filters."""
    rules, sites = url_filter.rule_table(spark), url_filter.site_table(spark)
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules, sites)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two vocabularies against each other, and how common its links are."""
    files = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
    found = token_alignment.link_scores(_table(spark, sf_dir, "documents"), *files)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_transactions": op1_warc_transactions,
    "op2_context_tree_scores": op2_context_tree_scores,
    "op3_lsh_forest_join": op3_lsh_forest_join,
    "op4_deobfuscated_toxicity": op4_deobfuscated_toxicity,
    "op5_preference_pairs": op5_preference_pairs,
    "op6_bit_packing": op6_bit_packing,
    "op7_piece_viterbi": op7_piece_viterbi,
    "op8_string_tiling": op8_string_tiling,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_multiset_fingerprint": op10_multiset_fingerprint,
    "op11_collocations": op11_collocations,
    "op12_bloom_cascade": op12_bloom_cascade,
    "op13_token_alignment": op13_token_alignment,
}

_OP5_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
),
last_turns AS (
  SELECT conv_id, max(turn) AS last_turn FROM turns WHERE role = 'assistant' GROUP BY conv_id
),
replies AS (
  SELECT t.conv_id, l.last_turn, max(t.text) AS reply
  FROM turns t JOIN last_turns l ON t.conv_id = l.conv_id AND t.turn = l.last_turn
  WHERE t.role = 'assistant' GROUP BY t.conv_id, l.last_turn
),
answers AS (
  SELECT r.conv_id, r.last_turn, r.reply, coalesce(n.reply, '') AS other
  FROM replies r LEFT JOIN replies n ON n.conv_id = r.conv_id + 1
),
marked AS (
  SELECT t.conv_id, t.turn, '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS shown,
    a.other,
    coalesce(t.turn = a.last_turn AND t.role = 'assistant' AND t.text = a.reply AND a.reply <> a.other, false) AS differs
  FROM turns t LEFT JOIN answers a ON t.conv_id = a.conv_id
  WHERE a.last_turn IS NULL OR t.turn <= a.last_turn
)
SELECT conv_id,
  count(*) FILTER (WHERE NOT differs)::INTEGER AS n_common,
  coalesce(string_agg(shown, '' ORDER BY turn) FILTER (WHERE NOT differs), '') AS prompt,
  coalesce(max(shown) FILTER (WHERE differs), '') AS chosen,
  coalesce(max('<|assistant|>' || chr(10) || other || '<|end|>' || chr(10)) FILTER (WHERE differs), '') AS rejected,
  coalesce(max(length(shown) - 14) FILTER (WHERE differs), 0)::BIGINT AS chosen_trained,
  coalesce(max(length(other) + 8) FILTER (WHERE differs), 0)::BIGINT AS rejected_trained
FROM marked GROUP BY conv_id
"""



def _base32_sql(hexadecimal: str) -> str:
    """RFC 4648 signs of a hexadecimal column of 40 digits: sign k holds the bits from 5 k on."""

    def sign(k: int) -> str:
        first, shift = divmod(5 * k, 4)
        digits = [f"(instr('0123456789abcdef', substr({hexadecimal}, {first + i + 1}, 1)) - 1)" for i in range(2)]
        value = f"(({digits[0]} * 16 + {digits[1]}) // {2 ** (3 - shift)}) % 32"
        return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ({value} + 1)::INTEGER, 1)"

    return " || ".join(map(sign, range(32)))


_OP1_SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex,
    max(page_id) OVER (PARTITION BY html) AS original
  FROM payloads
)
SELECT page_id, payload_bytes, {_base32_sql('hex')} AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to,
  1::INTEGER AS n_requests, 1::INTEGER AS n_metadata
FROM hashed
"""

def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


_OP12_SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
rules(h, p, v) AS (VALUES {_values(url_filter.RULES)}),
sites(s) AS (VALUES {_values((s,) for s in url_filter.SITES)}),
ruled AS (
  SELECT page_id, host, path,
    (SELECT max_by(struct_pack(rule := h || p, verdict := v), length(h || p)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS found,
    EXISTS (SELECT 1 FROM sites WHERE host = s OR ends_with(host, '.' || s)) AS listed
  FROM parsed
)
SELECT page_id, host, path, found.rule AS rule,
  coalesce(found.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc_transactions": _OP1_SQL,
    "op5_preference_pairs": _OP5_SQL,
    "op11_collocations": collocations_sql(),
    "op12_bloom_cascade": _OP12_SQL,
}
