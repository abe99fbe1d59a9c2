"""Phrase collocations by marginalising the longest windows.

Every word is counted once, as the head of its longest window: the word and up
to four that follow it (the lead columns ``w2`` to ``w5``), padded with ``''``
where its piece of text ends. No shorter phrase is ever formed from the text:
``GROUP BY lang, ROLLUP(w1, ..., w5)`` sums the windows over successively shorter
prefixes, and a prefix without padding is a phrase with all its occurrences. The
sum over all windows of a language is its number of words.

Windows end early where that changes no answer. A first pass adds up neighbouring
pairs in buckets of their hash, a second one the longer prefixes of windows whose
pairs all fell into buckets with the least count. What falls into a lower bucket is
rare for certain, no frequent phrase begins so, and the window is padded from there
on: beyond single words, what remains are the windows that phrases are made of.
Collisions only make windows longer. The buckets that reach the count are two
bitmaps of at most 2**30 bits (128 MB) each, whatever the corpus; their size follows
the bytes of text up to that bound, and beyond it windows are longer but the counts
the same.

Of each language's phrases of 2 to 5 words with at least ``least`` occurrences:
the score of a cut is ``floor(1000 * a * n / (l * r))`` in decimals of 38 digits; the
lowest cut counts (ties: the first); a phrase goes if a longer candidate that
contains it has at least ``share`` percent of its count; the best ``first`` of each
language are ranked by score, count and the phrase's bytes.

Tasks work on blocks of about 2 MB of text: a longer text is cut between its
pieces, where no window passes. Hot words and phrases leave a task as one row.

Edge cases: null texts are empty; a null language is ``und`` and one with a
language of that name; texts of separators only have no words; repeated rows
count again; a language without candidates has no rows; an empty table gives none.
Only A-Z are lower-cased. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.llm.common import pieces, text_of
from wearline.workspace import settle

LONGEST = 5
LEAST = 100
SHARE = 100
FIRST = 2_000
BLOCK_BYTES = 2_000_000
MOST_BITS = 30
RANKED = 100_000  # rows that one task may rank
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BORDERS = b".,;:!?\n\x0b\x0c\r"
_BORDER = b"\xff"  # no byte of UTF-8
_PLAIN = bytes.maketrans(_UPPER + _BORDERS, _UPPER.lower() + _BORDER * len(_BORDERS))


# --- text to word codes ----------------------------------------------------


def _blocks(batches, size: int) -> Iterator[tuple[str, bytes]]:
    """Language and text, lower-cased and with one sign for all borders, of about ``size`` bytes each."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(langs, texts):
            data = text.as_py().translate(_PLAIN)
            at = 0
            while len(data) - at > size and (cut := data.find(_BORDER, at + size)) >= 0:
                yield lang, data[at:cut]
                at = cut + 1
            held.setdefault(lang, []).append(data[at:])
            sizes[lang] = sizes.get(lang, 0) + len(data) - at
            if sizes[lang] >= size:
                yield lang, _BORDER.join(held.pop(lang))
                sizes[lang] = 0
    for lang, texts in held.items():
        yield lang, _BORDER.join(texts)


def _coded(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """Different words and the text as their numbers; number 0 is the border between pieces."""
    words = data.replace(_BORDER, b" " + _BORDER + b" ").split()
    known = dict.fromkeys([_BORDER])
    known.update(dict.fromkeys(words))
    number = dict(zip(known, range(len(known))))
    return list(known), np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _hashes(words: list[bytes], lang: str) -> np.ndarray:
    salt = pd.util.hash_array(np.array([lang.encode()], object), categorize=False)
    found = np.empty(len(words), object)
    found[:] = words
    return pd.util.hash_array(found, categorize=False) ^ salt


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _kept(bitmap: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (bitmap[buckets >> 3] >> (buckets & 7)) & 1 == 1


def _prefixes(words: list[bytes], codes: np.ndarray, lang: str, bits: int, known: list[np.ndarray]):
    """For sizes 1 to ``LONGEST``: the last word's numbers, where the prefix is open, and its buckets.

    One row per word of the text, as the head of its window. A prefix is open
    while its piece goes on and no bitmap of ``known`` (of pairs, then of longer
    prefixes) says that it, or a pair inside it, is rare.
    """
    hashes = _hashes(words, lang)
    heads = np.flatnonzero(codes > 0)
    padded = np.concatenate([codes, np.zeros(LONGEST, np.int64)])
    joins = np.ones(len(padded), bool)  # whether a word and the next may stand in one window
    prefix, open_ = np.zeros(len(heads), np.uint64), np.ones(len(heads), bool)
    for size in range(1, LONGEST + 1):
        last = padded[heads + size - 1]
        prefix = prefix * np.uint64(0xD6E8FEB86659FD93) + hashes[last]
        buckets = _bucket(prefix, bits)
        open_ = open_ & (last > 0)
        if size > 2:
            open_ = open_ & joins[heads + size - 2]
        if size > 1 and len(known) > (size > 2):
            kept = _kept(known[size > 2], buckets)
            open_ = open_ & kept
            if size == 2:
                joins[heads] = kept
        yield last, open_, buckets


# --- frequent buckets ------------------------------------------------------


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), text_of().alias("text"))


def bucket_bits(rows: DataFrame) -> int:
    """One bucket for about 16 bytes of text, at least 2**16 and at most 2**MOST_BITS."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_BITS, max(16, (size // 16).bit_length()))


def frequent_buckets(
    rows: DataFrame, least: int, bits: int, known: Sequence[np.ndarray] = (), block: int = BLOCK_BYTES
) -> np.ndarray:
    """Bitmap, lowest bit first, of the buckets whose prefixes occur ``least`` times together.

    Without ``known`` those of two words, with that bitmap the longer ones.
    """
    sent = rows.sparkSession.sparkContext.broadcast(list(known))

    def count(batches):
        for lang, data in _blocks(batches, block):
            words, codes = _coded(data)
            prefixes = list(_prefixes(words, codes, lang, bits, sent.value))
            chosen = prefixes[2:] if sent.value else prefixes[1:2]
            found, n = np.unique(np.concatenate([b[open_] for _, open_, b in chosen]), return_counts=True)
            yield pa.record_batch({"bucket": found, "n": n.astype(np.int64)})

    counts = rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    place = F.col("bucket") + 1  # Spark's bitmaps begin at 1
    parts = (
        counts.filter(F.col("n") >= least)
        .groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    )
    bitmap = np.zeros(max(1, 2**bits // 8), np.uint8)
    # At most 2**30 bits: the collected parts have that bound at any size of the input.
    for part, data in parts.toLocalIterator():
        at = (part - 1) * 4096
        bitmap[at : at + 4096] = np.frombuffer(data, np.uint8)[: len(bitmap) - at]
    return bitmap


# --- windows and their prefixes --------------------------------------------


def _distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of columns of numbers below ``size``, with how often each occurs."""
    key = columns[0]
    for column in columns[1:]:
        key = np.unique(key, return_inverse=True)[1] * size + column
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [column[first] for column in columns], n


def windows(rows: DataFrame, known: Sequence[np.ndarray], bits: int, block: int = BLOCK_BYTES) -> DataFrame:
    """Padded longest windows, counted inside blocks of text: ``lang``, ``w1`` ... ``w5``, ``n``."""
    sent = rows.sparkSession.sparkContext.broadcast(list(known))
    schema = ", ".join(["lang string", *(f"{w} string" for w in WORDS), "n long"])

    def count(batches):
        for lang, data in _blocks(batches, block):
            words, codes = _coded(data)
            # Number 0 stands for padding.
            columns = [np.where(o, last, 0) for last, o, _ in _prefixes(words, codes, lang, bits, sent.value)]
            if not len(columns[0]):
                continue
            columns, n = _distinct(columns, len(words))
            shown = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
            found = {w: shown.take(pa.array(c)) for w, c in zip(WORDS, columns)}
            yield pa.record_batch({"lang": pa.array([lang] * len(n)), **found, "n": n.astype(np.int64)})

    return rows.mapInArrow(count, schema)


def marginals(found: DataFrame, least: int) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``f`` of all phrases with ``least`` occurrences; size 0 counts all words."""
    size = LONGEST - F.bit_count(F.grouping_id())
    sets = [["lang", *WORDS[:k]] for k in range(LONGEST, -1, -1)]  # lang, ROLLUP(w1, ..., w5)
    summed = found.groupingSets(
        [[F.col(c) for c in one] for one in sets], "lang", *WORDS
    ).agg(size.cast("int").alias("size"), F.sum("n").alias("f"))
    last = F.get(F.array(*WORDS), F.col("size") - 1)
    # Prefixes that end in padding: a filter on grouping columns, so Spark drops them before anything is summed.
    phrases = summed.filter((F.col("size") == 0) | (last != ""))
    return phrases.filter(F.col("f") >= F.when(F.col("size") == 0, 0).otherwise(least)).select("lang", "size", F.concat_ws(" ", *WORDS).alias("phrase"), "f")


# --- scores ----------------------------------------------------------------


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    exact = [c.cast("decimal(38,0)") for c in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(38,0)") * exact[0] * exact[1], exact[2] * exact[3])


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """The lowest cut of every phrase of two words or more: ``lang``, ``phrase``, ``size``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    parts = phrases.filter("size >= 1").select("lang", F.col("phrase").alias("part"), "f")
    cuts = phrases.filter("size >= 2").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    first = F.expr("substring_index(phrase, ' ', k)")
    rest = F.expr("substring_index(phrase, ' ', k - size)")
    joined = (
        cuts.withColumn("part", first)
        .join(parts.withColumnRenamed("f", "l"), ["lang", "part"])
        .withColumn("part", rest)
        .join(parts.withColumnRenamed("f", "r"), ["lang", "part"])
        .join(totals, "lang")
    )
    cut = F.struct(_score(*map(F.col, ("a", "n", "l", "r"))).alias("score"), "k", "l", "r")
    lowest = joined.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(cut).alias("cut"))
    return lowest.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def without_contained(found: DataFrame, share: int) -> DataFrame:
    """Phrases that no longer candidate contains with ``share`` percent of their count."""
    inside = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
    )
    longer = found.filter("size >= 3").select(
        "lang", F.explode(F.array_distinct(inside)).alias("phrase"), F.col("a").alias("longer")
    )
    # Summed up per phrase before it moves: no phrase gathers its containers in one task.
    longest = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = found.join(longest, ["lang", "phrase"], "left")
    return joined.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")


def ranked(found: DataFrame, first: int) -> DataFrame:
    """The best ``first`` rows of each language, cut down in salted parts before one task ranks them."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    rows = found.count()
    while rows > RANKED:
        parts = pieces(rows, RANKED // 2)
        salted = found.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        place = F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))
        found = settle(salted.withColumn("__place", place).filter(F.col("__place") <= first).drop("__part", "__place"), "best")
        if (left := found.count()) > rows // 2:  # so many languages that parts are small already
            break
        rows = left
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return found.withColumn("rank", place.cast("long")).filter(F.col("rank") <= first)


def collocations(
    docs: DataFrame, least: int = LEAST, share: int = SHARE, first: int = FIRST, bits: int | None = None, block: int = BLOCK_BYTES
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's best phrases."""
    rows = _prepared(docs)
    bits = bits or bucket_bits(rows)
    known: list[np.ndarray] = []
    for _ in range(2):
        known.append(frequent_buckets(rows, least, bits, known, block))
    found = settle(marginals(windows(rows, known, bits, block), least), "phrases")
    totals = settle(found.filter("size = 0").select("lang", F.col("f").alias("n")), "totals")
    best = settle(without_contained(settle(scored(found, totals), "scored"), share), "candidates")
    return ranked(best, first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
