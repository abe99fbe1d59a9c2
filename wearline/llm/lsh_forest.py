"""Similarity join of documents on word shingles, with a MinHash LSH forest.

Shingles are runs of five words; two documents are linked if the Jaccard
similarity of their shingle sets is 0.8 or more.

1. A task turns every document into a fingerprint of its shingle set and a
   signature of ``TREES`` labels of ``DEPTH`` minima each. Documents with equal
   sets are one *text* from here on, however many copies there are.
2. Each tree is a prefix trie of its labels in sorted order: texts under a node
   share a prefix. Matching starts from whole labels and the prefix is shortened,
   minimum by minimum, until a pair exactly at the threshold meets in some tree
   with the target probability (0.999 by default: 5 of 8 minima in 20 trees).
   Texts under a common node are put into one cluster by union-find on
   (text, least text of the node) edges.
3. Clusters are verified exactly, all pairs: their texts meet in blocks of
   bounded size, large clusters in pairs of blocks, so neither a task nor a row
   holds a whole cluster. A task counts links per text and returns a spanning
   forest of the verified links, never the pairs.
4. Classes are the components of the verified links.

Verification costs what the links of a cluster cost: the square of its different
texts, spread over blocks. Copies cost nothing.

Words are what white space (ASCII) separates, in lower case. Edge cases: null and
empty texts have no shingles, are linked to nothing and each form a class of their
own; a text shorter than five words is one shingle; null ids are kept, and a class
is named by its least id that is not null; repeated rows have the same text and
class; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import text_of
from wearline.llm.components import components
from wearline.llm.tokenhash import byte_class, token_hashes
from wearline.workspace import settle

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 20, 8
TARGET = 0.999
BLOCK_TEXTS, BLOCK_CHARS = 1_000, 8_000_000
WORD_BYTES = ~byte_class(b" \t\n\r\x0b\x0c")


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different runs of words."""
    hashes, _ = token_hashes(text.lower().encode(), WORD_BYTES)
    if not len(hashes):
        return hashes
    count = max(1, len(hashes) - words + 1)
    with np.errstate(over="ignore"):
        value = np.zeros(count, np.uint64)
        for k in range(min(words, len(hashes))):
            value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
        value ^= value >> np.uint64(30)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(27)
    return np.unique(value)


@functools.cache
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    odd = random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], random.integers(0, 2**63, count, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """Minima of the shingles under ``trees * depth`` hash functions, 32 bits each."""
    odd, add = _multipliers(trees * depth)
    least = np.full(trees * depth, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[None, at : at + 2048]
            least = np.minimum(least, ((part ^ add) * odd).min(1))
    return (least >> np.uint64(32)).astype(np.uint32).reshape(trees, depth)


def recall(length: int, trees: int, threshold: float) -> float:
    """Probability that a pair at the threshold shares a prefix of this length in some tree."""
    return 1 - (1 - threshold**length) ** trees


def prefix_length(threshold: float, trees: int, depth: int, target: float) -> int:
    """Shorten the matched prefix from the whole label until the target recall."""
    length = depth
    while length > 1 and recall(length, trees, threshold) < target:
        length -= 1
    return length


def _prefix_keys(labels: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit key per tree for the first ``length`` minima of its label."""
    with np.errstate(over="ignore"):
        key = np.arange(1, len(labels) + 1, dtype=np.uint64) * np.uint64(0x94D049BB133111EB)
        for k in range(length):
            key = (key ^ labels[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _signed(
    docs: DataFrame, words: int, threshold: float, trees: int, depth: int, target: float
) -> DataFrame:
    """Every document with its text's name, size and prefix keys."""
    length = prefix_length(threshold, trees, depth, target)

    def sign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, keys = [], []
            for text in batch["text"]:
                found = shingle_set(text, words)
                if not len(found):
                    names.append(None)
                    keys.append(None)
                    continue
                with np.errstate(over="ignore"):
                    total = found.sum() + np.bitwise_xor.reduce(found) * np.uint64(0xC2B2AE3D27D4EB4F)
                names.append(int(total.view(np.int64)))
                keys.append(_prefix_keys(signature(found, trees, depth), length))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "copy": batch["copy"],
                    "chars": batch["chars"],
                    "name": pd.array(names, "Int64"),
                    "keys": pd.Series(keys, dtype=object),
                }
            )

    text = text_of()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("copy"),
        F.length(text).alias("chars"),
        text.alias("text"),
    )
    return rows.mapInPandas(sign, "doc_id long, copy long, chars int, name long, keys array<long>")


def _texts_of(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """``copy`` and ``text`` of the texts that are in clusters, each once.

    Texts move once, by their name, at any size of the input: sending the names
    to the tasks instead would serve small inputs only.
    """
    text = text_of()
    wanted = placed.select("copy").distinct().hint("merge")
    rows = docs.select(F.xxhash64(text).alias("copy"), text.alias("text"))
    return rows.join(wanted, "copy", "left_semi").dropDuplicates(["copy"])


def _verify(words: int, threshold: float):
    """Links of one pair of blocks, from shared shingles counted as matrix products."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("name", kind="stable")
        sets = [shingle_set(t, words) for t in rows["text"]]
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
        # Shingles of one text only are shared with nothing.
        order = np.cumsum(seen > 1) - 1
        owner = np.repeat(np.arange(len(sets)), sizes)
        common = seen[column] > 1
        owner, column = owner[common], order[column[common]]
        by_column = np.argsort(column, kind="stable")
        owner, column = owner[by_column], column[by_column]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            low, high = np.searchsorted(column, [first, first + 2048])
            part = np.zeros((len(sets), 2048), np.float32)
            part[owner[low:high], column[low:high] - first] = 1
            shared += part @ part.T
        linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
        # Exactly at the threshold in whole numbers, as products are exact below 2**24.
        union = sizes[:, None] + sizes[None, :] - shared
        linked &= shared.astype(np.float64) / np.maximum(union, 1) >= threshold
        np.fill_diagonal(linked, False)
        block = rows["block"].to_numpy()
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            linked &= block[:, None] != block[None, :]
        names = rows["name"].to_numpy()
        root = np.arange(len(sets))
        for start in range(len(sets)):
            if root[start] != start:
                continue
            front = np.array([start])
            while len(front):
                near = np.flatnonzero(linked[front].any(0) & (root == np.arange(len(sets))))
                front = near[near > start]
                root[front] = start
        return pd.DataFrame({"name": names, "root": names[root], "links": linked.sum(1)})

    return links


def classes(
    docs: DataFrame,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    target: float = TARGET,
    block_texts: int = BLOCK_TEXTS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id``, ``class_id`` (least id of the class) and ``n_links`` of every document.

    ``n_links`` counts the different texts, by shingle set, that a document's
    text is linked to; copies of the same text are in its class and not counted.
    """
    signed = settle(_signed(docs, words, threshold, trees, depth, target), "signatures")
    named = signed.filter("name is not null")
    texts = named.groupBy("name").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("copy", "chars", "keys")).alias("one")
    )
    texts = settle(texts.select("name", "least_id", "one.*"), "texts")

    nodes = texts.select("name", F.explode("keys").alias("key"))
    shared = nodes.groupBy("key").agg(F.min("name").alias("least"), F.count(F.lit(1)).alias("n"))
    shared = settle(shared.filter("n > 1").drop("n"), "shared-nodes")
    edges = nodes.join(shared, "key").select(F.col("name").alias("a"), F.col("least").alias("b"))
    clusters = components(edges).select(F.col("node").alias("name"), F.col("component").alias("cluster"))

    placed = texts.select("name", "copy", "chars").join(clusters, "name")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("chars").alias("c"))
    blocks = F.ceil(F.greatest(F.col("m") / block_texts, F.col("c") / block_chars)).cast("int")
    sizes = settle(sizes.select("cluster", blocks.alias("blocks")), "cluster-sizes")
    placed = placed.join(sizes, "cluster").withColumn("block", F.pmod(F.hash("name"), F.col("blocks")))
    placed = settle(placed.select("name", "copy", "cluster", "blocks", "block"), "placed-texts")

    found = _texts_of(docs, placed)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        found.join(placed, "copy")
        .withColumn("other", other)
        .select(
            "cluster",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "name",
            "text",
        )
    )
    verified = met.groupBy("cluster", "i", "j").applyInPandas(
        _verify(words, threshold), "name long, root long, links long"
    )
    verified = settle(verified, "verified-links")

    linked = components(verified.filter("name <> root").select(F.col("name").alias("a"), F.col("root").alias("b")))
    linked = linked.select(F.col("node").alias("name"), "component")
    counts = verified.groupBy("name").agg(F.sum("links").alias("n_links"))
    facts = texts.select("name", "least_id").join(linked, "name", "left").join(counts, "name", "left")
    facts = settle(
        facts.select(
            "name",
            "least_id",
            F.coalesce("component", "name").alias("component"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        ),
        "text-classes",
    )
    least = settle(facts.groupBy("component").agg(F.min("least_id").alias("class_id")), "class-names")
    facts = settle(facts.join(least, "component").select("name", "class_id", "n_links"), "text-facts")
    return signed.select("doc_id", "name").join(facts, "name", "left").select(
        "doc_id",
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """One document of every class, the one with the least id; columns as they came."""
    found = classes(docs, **settings)
    gone = settle(found.filter("doc_id <> class_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
