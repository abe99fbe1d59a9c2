"""Document fingerprints that are sums: a homomorphic multiset hash of paragraphs.

A paragraph (a line that is not empty) hashes to a wide vector, and the
fingerprint of a document is the sum of its paragraphs' vectors, lane by lane,
modulo a power of two. The order of paragraphs does not matter, equal multisets
have equal fingerprints, and a paragraph is inserted or deleted by adding or
subtracting its vector (``plus``, ``minus``) without reading the rest.

Two kinds of lanes make up a vector:

* 16 lanes modulo 2**32, the digits of the paragraph's SHA-512: equality of all
  of them is equality of the multisets but for collisions of that hash;
* 128 lanes: every run of three words of the paragraph (the whole paragraph if
  it is shorter) adds +1 or -1 to one lane, both taken from its hash. The cosine
  of two documents' lanes estimates the cosine of their multisets of runs, with
  an error of about 0.09; below 0 counts as 0. This is the likeness, and it is one
  of fingerprints: lanes are kept modulo 2**32 and read as signed numbers, which
  no text of less than 2**31 runs leaves (``likeness_of`` takes two fingerprints).

Everything is built-in Spark functions. The next document in order of the id is
found without sorting all documents in one task: documents are windowed inside
blocks of 64 consecutive ids, and only the first document of a block is carried
to the block before it; which ids these are is found without the texts. Which block follows which is settled on block numbers
alone, 1,024 to a window, level above level.

Edge cases: null texts are empty; an empty text has no paragraph and the zero
fingerprint; two zero fingerprints have likeness 1, a zero one and another 0;
null ids come first in order; rows with equal ids are ordered by text; repeated
rows stay; the document after the last is the first, which for a table of one
row is the same one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.llm.common import text_of
from wearline.workspace import settle

EXACT_LANES, EXACT_BITS = 16, 32
LIKE_LANES, LIKE_BITS = 128, 32
RUN = 3
BLOCK = 64
SPAN = 1_024
SINGLE = 10_000  # block numbers that one window may order
SENT_FIRSTS = 2_000_000  # firsts of blocks that are sent to the tasks; more are joined
_FIRST = -(2**63)


# --- the order of documents ------------------------------------------------


def successors(keys: DataFrame) -> DataFrame:
    """``key`` and ``next``, the next larger key or null, of distinct whole numbers."""
    if keys.count() <= SINGLE:
        return keys.select("key", F.lead("key").over(Window.orderBy("key")).alias("next"))
    grouped = settle(keys.select("key", F.expr(f"key div {SPAN}").alias("group")), "keys")
    firsts = settle(grouped.groupBy("group").agg(F.min("key").alias("first")), "groups")
    after = successors(firsts.select(F.col("group").alias("key")))
    after = after.join(firsts.withColumnRenamed("group", "next"), "next")
    inside = F.lead("key").over(Window.partitionBy("group").orderBy("key"))
    found = grouped.withColumn("inside", inside).join(
        after.select(F.col("key").alias("group"), F.col("first").alias("beyond")), "group", "left"
    )
    return found.select("key", F.coalesce("inside", "beyond").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """``block``, ``place``, ``doc_id``, ``text`` and ``next_text`` of every document."""
    order = F.coalesce(F.col("doc_id"), F.lit(_FIRST))
    rows = docs.select(
        # Never null, and seen to be so: else a join adds a filter to one of two equal exchanges.
        F.coalesce(F.expr(f"coalesce(doc_id, {_FIRST + 1} - 1) div {BLOCK}"), F.lit(0).cast("long")).alias("block"),
        "doc_id",
        text_of().alias("text"),
    )
    inside = Window.partitionBy("block").orderBy(order, "text")
    placed = rows.withColumns(
        {"place": F.row_number().over(inside), "next_text": F.lead("text").over(inside)}
    )
    blocks = settle(rows.select(F.col("block").alias("key")).distinct(), "blocks")
    follows = settle(successors(blocks), "block-order")
    first = follows.agg(F.min("key")).first()[0]
    # The first id of a block comes from map-side minima of numbers; only its texts are looked up.
    firsts = settle(rows.select("block", order.alias("order")).groupBy("block").agg(F.min("order").alias("order")), "firsts")
    listed = F.broadcast(firsts) if firsts.count() <= SENT_FIRSTS else firsts
    heads = rows.select("block", order.alias("order"), "text").join(listed, ["block", "order"])
    heads = heads.groupBy("block").agg(F.min("text").alias("head")).withColumnRenamed("block", "next")
    follows = follows.select(F.col("key").alias("block"), F.coalesce("next", F.lit(first)).alias("next"))
    heads = settle(follows.join(heads, "next").select("block", "head"), "block-heads")
    return placed.join(heads, "block", "left").select(
        "block", "place", "doc_id", "text", F.coalesce("next_text", "head").alias("next_text")
    )


def edited(text: Column, other: Column) -> Column:
    """The text with its last quarter replaced by as much of the start of the other."""
    size = F.length(text)
    quarter = F.floor(size / 4).cast("int")
    kept = F.substring(text, F.lit(1), size - quarter)
    return F.concat(kept, F.substring(other, F.lit(1), quarter))


# --- vectors ---------------------------------------------------------------


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def exact_lanes(text: Column) -> Column:
    """Sum of the paragraphs' SHA-512 digits, as ``EXACT_LANES`` numbers below 2**32."""
    zero = F.array_repeat(F.lit(0).cast("long"), EXACT_LANES)

    def digits(hashed: Column) -> Column:
        return F.array(
            *(F.conv(F.substring(hashed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(EXACT_LANES))
        )

    # One step per transform: inside a lambda an expression is evaluated as often as it is written.
    hashes = F.transform(paragraphs(text), lambda p: F.sha2(p, 512))
    return F.aggregate(
        F.transform(hashes, digits), zero, lambda total, lanes: _add(total, lanes, EXACT_BITS)
    )


def _add(a: Column, b: Column, bits: int, sign: int = 1) -> Column:
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(2**bits)))


def runs(text: Column) -> Column:
    """Hashes of the runs of ``RUN`` words inside paragraphs, repeats and all."""

    def of(words: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(words) - RUN),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(RUN))),
        )
        return F.when(F.size(words) < RUN, F.array(F.xxhash64(words))).otherwise(several)

    return F.flatten(F.transform(F.transform(paragraphs(text), lambda p: F.split(p, " ")), of))


def plus(a: Column, b: Column, bits: int) -> Column:
    """Fingerprint lanes after inserting the paragraphs of ``b``."""
    return _add(a, b, bits)


def minus(a: Column, b: Column, bits: int) -> Column:
    """Fingerprint lanes after deleting the paragraphs of ``b``."""
    return _add(a, b, bits, -1)


def _shown(lanes: Column, bits: int) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), bits // 4, "0")), "")


def _wrapped(lanes: Column) -> Column:
    return F.transform(lanes, lambda x: F.pmod(x, F.lit(2**LIKE_BITS)))


def _signed(wrapped: Column) -> Column:
    """Lanes as a fingerprint holds them, read as signed numbers."""
    return F.transform(wrapped, lambda x: F.when(x >= 2 ** (LIKE_BITS - 1), x - F.lit(2**LIKE_BITS)).otherwise(x))


def like_lanes_of(fingerprint: Column) -> Column:
    """The likeness lanes of a fingerprint."""
    digits, first = LIKE_BITS // 4, EXACT_LANES * EXACT_BITS // 4
    lane = lambda k: F.conv(F.substring(fingerprint, k * digits + first + 1, F.lit(digits)), 16, 10).cast("long")
    return _signed(F.transform(F.sequence(F.lit(0), F.lit(LIKE_LANES - 1)), lane))


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints."""
    return likeness(like_lanes_of(a), like_lanes_of(b))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two arrays of likeness lanes, from 0 to 1."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    size = dot(a, a) * dot(b, b)
    cosine = F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(a, b) / F.sqrt(size)))
    return F.when(size > 0, cosine).otherwise(F.when(a == b, 1.0).otherwise(0.0))


def like_lanes(rows: DataFrame, key: list[str], sides: dict[str, str]) -> DataFrame:
    """Likeness lanes (whole sums) of several text columns: ``key`` and one array per side.

    Runs are added up per (row, side, lane). If the rows lie by a part of the
    key already, no row moves.
    """
    each = rows.select(
        *key,
        F.explode(
            F.array(*(F.struct(F.lit(k).alias("side"), runs(F.col(c)).alias("runs")) for k, c in enumerate(sides.values())))
        ).alias("s"),
    ).select(*key, F.col("s.side").alias("side"), F.explode("s.runs").alias("run"))
    lane = F.pmod(F.col("run"), F.lit(LIKE_LANES)).cast("int")
    sign = F.when(F.shiftright("run", 40) % 2 == 0, 1).otherwise(-1)
    summed = (
        each.select(*key, "side", lane.alias("lane"), sign.alias("sign"))
        .groupBy(*key, "side", "lane")
        .agg(F.sum("sign").alias("n"))
    )
    entry = F.struct((F.col("side") * LIKE_LANES + F.col("lane")).alias("k"), F.col("n").alias("v"))
    found = summed.groupBy(*key).agg(F.map_from_entries(F.collect_list(entry)).alias("sums"))

    def array_of(k: int) -> Column:
        return F.transform(
            F.sequence(F.lit(k * LIKE_LANES), F.lit((k + 1) * LIKE_LANES - 1)),
            lambda i: F.coalesce(F.try_element_at("sums", i), F.lit(0).cast("long")),
        )

    return found.select(*key, *(array_of(k).alias(name) for k, name in enumerate(sides)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likenesses."""
    key = ["block", "place"]
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    # With the id, lanes and facts read the same columns, so the texts move once for both.
    like = like_lanes(rows, [*key, "doc_id"], {"own": "text", "other": "edited", "next": "next_text"}).drop("doc_id")
    facts = rows.select(
        *key,
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        exact_lanes(F.col("text")).alias("exact"),
        exact_lanes(F.col("edited")).alias("exact_edited"),
    )
    none = F.array_repeat(F.lit(0).cast("long"), LIKE_LANES)
    full = facts.join(like, key, "left").withColumns(
        {c: _wrapped(F.coalesce(F.col(c), none)) for c in ("own", "other", "next")}
    )
    return full.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.concat(_shown(F.col("exact"), EXACT_BITS), _shown(F.col("own"), LIKE_BITS)).alias("fingerprint"),
        F.concat(_shown(F.col("exact_edited"), EXACT_BITS), _shown(F.col("other"), LIKE_BITS)).alias(
            "edited_fingerprint"
        ),
        likeness(_signed(F.col("own")), _signed(F.col("other"))).alias("near_edited"),
        likeness(_signed(F.col("own")), _signed(F.col("next"))).alias("near_next"),
    )
