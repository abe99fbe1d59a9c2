"""URL filtering with cascades of Bloom filters: exact membership without a join.

A list of keys becomes a cascade. Its first Bloom filter holds the listed keys.
Every key of the corpus is held against it, and those that pass without being
listed are the second filter's content; listed keys that pass the second one are
the third one's, and so on with an own hash in each level until nothing wrong
passes. A key is judged by the first level that rejects it. Since the levels were
made over all keys that the corpus can ask for, the answer is exact for each of
them, and a page is judged by looking at a few bits.

Keys of a url are a suffix of its host (whole labels) followed by a prefix of its
path, in the shapes (number of labels, length of path) that the lists use. Two
cascades hold the rules that allow and that block; of a url's keys in them the
longest is its rule (ties: more host labels; the same key in both lists blocks).
A third one holds the method's own sites: without a rule, a url is blocked if its
host or a parent domain of it is such a site, else allowed.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: from there up to ``?``, ``#`` or the end.

Filters take 8 to 16 bits a key, so their size follows the lists and the few false
positives, not the pages. Up to ``FILTER_BITS`` they are sent to the tasks; longer
lists are held against the keys by a join instead, with the same results.

Edge cases: a null url or one without ``://`` has an empty host and path and no key;
repeated pages and page ids stay; empty lists allow everything; an empty table
gives none; rules listed twice count once; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.workspace import settle

HASHES = 4
FILTER_BITS = 2**30  # 128 MB
ALLOW, BLOCK = "allow", "block"
LISTS = (ALLOW, BLOCK, "sites")
# Sites that the query's own list blocks.
SITES = (
    "ads-track.example.com",
    "adult-x.example.com",
    "casino-win.example.net",
    "cheap-pills.example.net",
    "free-bets.example.net",
    "spam-farm.example.org",
)


# --- urls ------------------------------------------------------------------


def host_of(url: Column) -> Column:
    found = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def key_shapes(lists: DataFrame) -> list[tuple[int, int]]:
    """Different (host labels, path length) of the lists: the shapes of keys to ask for."""
    shapes = lists.select(F.size(_labels(F.col("host"))).alias("labels"), F.length("path").alias("length"))
    return sorted((r["labels"], r["length"]) for r in shapes.distinct().toLocalIterator())


def keys_of(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """Keys of a url in these shapes, the longest first."""
    if not shapes:
        return F.array().cast("array<string>")
    labels = _labels(host)
    given = F.array(*(F.struct(F.lit(n).alias("labels"), F.lit(q).alias("length")) for n, q in shapes))
    fitting = F.filter(given, lambda s: (s["labels"] <= F.size(labels)) & (s["length"] <= F.length(path)))

    def key(shape: Column) -> Column:
        suffix = F.array_join(F.slice(labels, F.size(labels) - shape["labels"] + 1, shape["labels"]), ".")
        whole = F.concat(suffix, F.substring(path, F.lit(1), shape["length"]))
        return F.struct(F.length(whole).alias("size"), shape["labels"].alias("labels"), whole.alias("key"))

    ordered = F.sort_array(F.transform(fitting, key), asc=False)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(ordered, lambda k: k["key"]))


# --- filters ---------------------------------------------------------------


def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """``HASHES`` bit places of each key in a filter of ``size`` bits, a power of two."""
    hashed = pd.util.hash_array(keys, hash_key=f"{level:016d}", categorize=False)
    step = (hashed >> np.uint64(32)) | np.uint64(1)
    times = np.arange(HASHES, dtype=np.uint64)
    return ((hashed[:, None] + times * step[:, None]) & np.uint64(size - 1)).astype(np.int64)


@dataclass(frozen=True)
class Cascade:
    """Bitmaps level by level; the first holds listed keys, the next false positives, and so on."""

    levels: tuple[np.ndarray, ...] = ()

    @property
    def bits(self) -> int:
        return 8 * sum(map(len, self.levels))

    def passes(self, keys: np.ndarray, level: int) -> np.ndarray:
        bitmap = self.levels[level]
        at = places(keys, level, 8 * len(bitmap))
        return ((bitmap[at >> 3] >> (at & 7)) & 1).all(axis=1)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Membership, exact for every key of the universe that the cascade was made over."""
        listed, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for level in range(len(self.levels)):
            left = left[self.passes(keys[left], level)]
            listed[left] = level % 2 == 0
        return listed


def _objects(column: pa.Array) -> np.ndarray:
    found = np.empty(len(column), object)
    found[:] = column.to_pylist()
    return found


def _size(keys: int) -> int:
    return max(1 << 15, 1 << (8 * keys - 1).bit_length())


def bloom_bitmap(keys: DataFrame, level: int, size: int) -> np.ndarray:
    """The filter of distinct keys, its parts of 4 KB put together by Spark."""

    def spread(batches):
        for batch in batches:
            yield pa.record_batch({"place": np.unique(places(_objects(batch.column(0)), level, size)) + 1})

    parts = (
        keys.select("key")
        .mapInArrow(spread, "place long")
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    )
    bitmap = np.zeros(size // 8, np.uint8)
    for part, data in parts.toLocalIterator():
        bitmap[(part - 1) * 4096 : part * 4096] = np.frombuffer(data, np.uint8)
    return bitmap


def _passing(keys: DataFrame, cascades: Sequence[Cascade], level: int) -> DataFrame:
    """Keys that pass this level of at least one of the cascades."""
    sent = keys.sparkSession.sparkContext.broadcast([c for c in cascades if len(c.levels) > level])

    def test(batches):
        for batch in batches:
            found = _objects(batch.column(0))
            hit = np.zeros(len(found), bool)
            for cascade in sent.value:
                hit |= cascade.passes(found, level)
            yield batch.filter(pa.array(hit))

    return keys.select("key").mapInArrow(test, "key string")


def build_cascades(lists: dict[str, DataFrame], universe: DataFrame, most_bits: int = FILTER_BITS) -> dict[str, Cascade] | None:
    """One cascade for each list of distinct keys over all keys of the universe, repeats and all.

    None if the filters would be larger than ``most_bits``. The universe is scanned
    once for all lists; only what passes a first filter moves.
    """
    counts = {name: keys.count() for name, keys in lists.items()}
    if sum(_size(n) for n in counts.values() if n) > most_bits:
        return None
    found = {n: Cascade((bloom_bitmap(k, 0, _size(counts[n])),)) if counts[n] else Cascade() for n, k in lists.items()}
    suspects = settle(_passing(universe, list(found.values()), 0).distinct(), "suspects")
    for name, listed in lists.items():
        if not counts[name]:
            continue
        passed = settle(_passing(suspects, [found[name]], 0).join(listed, "key", "left_anti"), "false-positives")
        inside, outside = listed, passed
        while True:
            level = len(found[name].levels)
            # Even levels hold listed keys, odd ones keys that passed without being listed.
            content, other = (inside, outside) if level % 2 == 0 else (outside, inside)
            if not (n := content.count()):
                break
            if sum(c.bits for c in found.values()) + _size(n) > most_bits:
                return None
            found[name] = Cascade((*found[name].levels, bloom_bitmap(content, level, _size(n))))
            other = settle(_passing(other, [found[name]], level), "passed")
            inside, outside = (content, other) if level % 2 == 0 else (other, content)
    return found


# --- verdicts --------------------------------------------------------------


def _by_filters(rows: DataFrame, cascades: dict[str, Cascade]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast([cascades[name] for name in LISTS])
    kept = [c for c in rows.columns if c != "keys"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "rule string", "verdict string"])

    def judge(batches):
        allow, block, sites = sent.value
        for batch in batches:
            keys = batch.column("keys")
            flat = _objects(keys.flatten())
            owner = pc.list_parent_indices(keys).to_numpy()
            blocks = block.holds(flat)
            ruled = np.flatnonzero(blocks | allow.holds(flat))
            rows_, first = np.unique(owner[ruled], return_index=True)  # the longest key comes first
            rule = np.full(len(batch), None, object)
            verdict = np.full(len(batch), ALLOW, object)
            verdict[owner[sites.holds(flat)]] = BLOCK
            rule[rows_] = flat[ruled[first]]
            verdict[rows_] = np.where(blocks[ruled[first]], BLOCK, ALLOW)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*kept, "rule", "verdict"],
            )

    return rows.mapInArrow(judge, schema)


def _by_join(rows: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """The same for lists too long to send: each key of a url is looked up in its turn."""
    marked = None
    for name, keys in lists.items():
        part = keys.select("key", F.lit(name).alias("list"))
        marked = part if marked is None else marked.unionByName(part)
    marks = marked.groupBy("key").agg(F.collect_set("list").alias("lists"))  # three at most
    kept = [c for c in rows.columns if c != "keys"]
    numbered = settle(rows.withColumn("__row", F.monotonically_increasing_id()), "urls")
    asked = numbered.select("__row", F.posexplode("keys").alias("turn", "key")).join(marks, "key")
    ruled = F.arrays_overlap("lists", F.array(F.lit(ALLOW), F.lit(BLOCK)))
    blocks = F.when(F.array_contains("lists", BLOCK), BLOCK).otherwise(ALLOW)
    found = asked.groupBy("__row").agg(
        F.min(F.when(ruled, F.struct("turn", "key", blocks.alias("verdict")))).alias("rule"),
        F.bool_or(F.array_contains("lists", "sites")).alias("listed"),
    )
    own = F.when(F.col("listed"), BLOCK).otherwise(ALLOW)
    return numbered.join(found, "__row", "left").select(
        *kept, F.col("rule.key").alias("rule"), F.coalesce("rule.verdict", own).alias("verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, sites: DataFrame, most_bits: int = FILTER_BITS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every page.

    ``rules`` has ``host``, ``path``, ``verdict``; ``sites`` has ``host``.
    """
    lists = settle(
        rules.select(F.col("verdict").alias("list"), "host", "path")
        .unionByName(sites.select(F.lit("sites").alias("list"), "host", F.lit("").alias("path")))
        .filter(F.col("host") != "").distinct(),
        "lists",
    )
    shapes = key_shapes(lists)
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = parsed.withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))
    keys = {
        name: settle(lists.filter(F.col("list") == name).select(F.concat("host", "path").alias("key")).distinct(), name)
        for name in LISTS
    }
    cascades = build_cascades(keys, rows.select(F.explode("keys").alias("key")), most_bits)
    return _by_join(rows, keys) if cascades is None else _by_filters(rows, cascades)


# The rules of the registered query.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def site_table(spark: SparkSession, sites: Sequence[str] = SITES) -> DataFrame:
    return spark.createDataFrame([(s,) for s in sites], "host string")
