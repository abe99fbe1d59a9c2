"""Benchmark decontamination by greedy string tiling.

A document is held against every benchmark item with which it shares a *seed*,
a run of ``min_match`` tokens. Greedy string tiling then covers the item with
the longest matches first: matches of the current length are found by
Karp-Rabin hashes of running windows over unmarked tokens, extended as far as
they go, and marked from the longest to the shortest unless an earlier tile took
their tokens; then the length is lowered, down to ``min_match``. Tiles never
overlap in either text and may lie in any order, so moved sentences count in
full. The share of the item's tokens under tiles is its coverage; an item with a
coverage of ``threshold`` or more contaminates the document.

The benchmark is the small side by nature but its size is measured, never
assumed: it is dealt by a hash of the item into slices of about ``slice_chars``
characters, and the documents are joined with one slice after another. A slice
is what a task holds of the benchmark. An ordinary benchmark is one slice and
costs one scan of the documents without any shuffle; a larger one costs more
scans and is still compared whole. Candidates are dropped before tiling only
where the shared seeds prove that the coverage cannot be reached.

Edge cases: null texts are empty; a text without tokens neither contaminates
nor is contaminated; an item shorter than ``min_match`` tokens has to occur as a
whole; null ids are kept as null; repeated documents and items are compared each
for itself; an empty table on either side gives no rows.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import pieces, scalar, text_of
from wearline.llm.tokenhash import byte_class, token_hashes

MIN_MATCH = 5
THRESHOLD = 0.5
SLICE_CHARS = 16_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Tokens: runs of lower-case ASCII letters, digits and underscores, and of other characters than ASCII.
TOKEN_BYTES = byte_class(b"_0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def _window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` ids, modulo 2**64."""
    return _hashes_at(ids, np.arange(len(ids) - length + 1), length)


def _hashes_at(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        value = np.zeros(len(at), np.uint64)
        for k in range(length):
            value = value * _BASE + mixed[at + k]
    return value


def _free_windows(marked: np.ndarray, length: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(marked)])
    return taken[length:] == taken[:-length]


def _matches(
    doc: np.ndarray, item: np.ndarray, doc_marked: np.ndarray, item_marked: np.ndarray, length: int
) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches of at least ``length`` tokens: (size, item start, doc start)."""
    doc_hash, item_hash = _window_hashes(doc, length), _window_hashes(item, length)
    doc_at = np.flatnonzero(_free_windows(doc_marked, length)) if len(doc_hash) else []
    item_at = np.flatnonzero(_free_windows(item_marked, length)) if len(item_hash) else []
    if not len(doc_at) or not len(item_at):
        return []
    doc_at = doc_at[np.isin(doc_hash[doc_at], item_hash[item_at])]
    order = doc_at[np.argsort(doc_hash[doc_at], kind="stable")]
    keys = doc_hash[order]
    found = []
    for j in map(int, item_at):
        low, high = np.searchsorted(keys, item_hash[j], "left"), np.searchsorted(keys, item_hash[j], "right")
        for i in map(int, order[low:high]):
            if i and j and not doc_marked[i - 1] and not item_marked[j - 1] and doc[i - 1] == item[j - 1]:
                continue  # a longer match begins earlier on this diagonal
            most = min(len(doc) - i, len(item) - j)
            same = (doc[i : i + most] == item[j : j + most]) & ~doc_marked[i : i + most] & ~item_marked[j : j + most]
            size = most if same.all() else int(np.argmin(same))
            if size >= length:
                found.append((size, j, i))
    return found


def tile(doc: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles of two id arrays: (size, item start, doc start), longest first.

    Of equal matches the one that starts first in the item, then in the
    document, is taken.
    """
    least = max(1, min(min_match, len(item)))
    doc_marked, item_marked = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 4 * least))
    while len(item) and len(doc):
        found = _matches(doc, item, doc_marked, item_marked, length)
        longest = max((size for size, _, _ in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        queue = defaultdict(list)
        for size, j, i in found:
            queue[size].append((j, i))
        for size in range(longest, length - 1, -1):
            for j, i in sorted(queue.pop(size, ())):
                free = ~(doc_marked[i : i + size] | item_marked[j : j + size])
                if free.all():
                    doc_marked[i : i + size] = item_marked[j : j + size] = True
                    tiles.append((size, j, i))
                    continue
                # What an earlier tile left of this match waits for its own length.
                edges = np.flatnonzero(np.diff(np.concatenate([[0], free, [0]])))
                for start, stop in zip(edges[::2], edges[1::2]):
                    if stop - start >= length:
                        queue[int(stop - start)].append((j + int(start), i + int(start)))
        if length == least:
            break
        length = max(least, length // 2)
    return tiles


@dataclass
class Benchmark:
    """One slice of the benchmark as arrays, with its seeds sorted for probing."""

    item_ids: list
    items: list[np.ndarray]
    vocabulary: np.ndarray  # sorted hashes of all tokens
    seeds: dict[int, tuple[np.ndarray, np.ndarray]]  # by seed length: hashes, items
    repeats: list[bool]  # whether a seed occurs twice in the item
    min_match: int

    @classmethod
    def of(cls, rows: Sequence[tuple[object, str]], min_match: int) -> "Benchmark":
        hashed = [(item_id, token_hashes(text.lower().encode(), TOKEN_BYTES)[0]) for item_id, text in rows]
        hashed = [(item_id, found) for item_id, found in hashed if len(found)]
        item_ids = [item_id for item_id, _ in hashed]
        vocabulary = np.unique(np.concatenate([np.zeros(1, np.uint64), *(h for _, h in hashed)]))
        items = [np.searchsorted(vocabulary, found) + 1 for _, found in hashed]
        seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_length = defaultdict(list)
        repeats = []
        for k, ids in enumerate(items):
            length = min(min_match, len(ids))
            hashes = np.unique(_window_hashes(ids, length))
            repeats.append(len(hashes) < len(ids) - length + 1)
            by_length[length].append((hashes, k))
        for length, found in by_length.items():
            hashes = np.concatenate([h for h, _ in found])
            owner = np.concatenate([np.full(len(h), k) for h, k in found])
            order = np.argsort(hashes, kind="stable")
            seeds[length] = hashes[order], owner[order]
        return cls(item_ids, items, vocabulary, seeds, repeats, min_match)

    def _ids(self, run: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the tokens of many texts, with a 0 after each; where each begins and ends."""
        data = [text.lower().encode() for text in run]
        hashes, at = token_hashes(b"\n".join(data), TOKEN_BYTES)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[place] == hashes, place + 1, 0)
        ends = np.searchsorted(at, np.cumsum([len(d) + 1 for d in data]))
        flat = np.insert(ids, ends, 0)
        ends = ends + np.arange(len(ends))
        return flat, np.concatenate([[0], ends[:-1] + 1]), ends

    def candidates(self, flat: np.ndarray, starts: np.ndarray, threshold: float) -> list[tuple[int, int]]:
        """(text number, item) pairs that share seeds, enough of them to reach the threshold.

        ``flat`` holds the token ids of many texts, 0 for tokens that no item
        has and between texts; only windows without 0 are hashed and probed.
        """
        chosen = set()
        unknown = np.concatenate([[0], np.cumsum(flat == 0)])
        for length, (hashes, owner) in self.seeds.items():
            at = np.flatnonzero(unknown[length:] == unknown[:-length]) if len(flat) >= length else []
            if not len(at):
                continue
            own = _hashes_at(flat, at, length)
            low = np.searchsorted(hashes, own, "left")
            high = np.searchsorted(hashes, own, "right")
            shared = set()
            for h in np.flatnonzero(high > low):
                text = int(np.searchsorted(starts, at[h], "right")) - 1
                shared.update((text, int(k), int(own[h])) for k in owner[low[h] : high[h]])
            seeds = Counter((text, k) for text, k, _ in shared)
            for (text, k), n in seeds.items():
                # Tiles consist of shared seeds, so n different ones bound what they cover.
                covered = len(self.items[k]) if self.repeats[k] else n * length
                if covered >= threshold * len(self.items[k]):
                    chosen.add((text, k))
        return sorted(chosen)

    def tiled(self, texts: Sequence[str], threshold: float) -> list[tuple[int, int, int, list]]:
        """(text number, item, tokens under tiles, tiles) of the pairs that reach the threshold."""
        found = []
        for first, run in _runs(texts):
            flat, starts, ends = self._ids(run)
            for text, k in self.candidates(flat, starts, threshold):
                tiles = tile(flat[starts[text] : ends[text]], self.items[k], self.min_match)
                covered = sum(size for size, _, _ in tiles)
                if covered and covered >= threshold * len(self.items[k]):
                    found.append((first + text, k, covered, tiles))
        return found


def _runs(texts: Sequence[str], chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about ``chars`` characters, each with the number of its first."""
    run: list[str] = []
    first = size = 0
    for k, text in enumerate(texts):
        run.append(text)
        size += len(text)
        if size >= chars:
            yield first, run
            run, first, size = [], k + 1, 0
    if run:
        yield first, run


def _slices(benchmark: DataFrame, min_match: int, slice_chars: int) -> Iterator[Benchmark]:
    items = benchmark.select("item_id", text_of().alias("text"))
    count = pieces(scalar(items.agg(F.sum(F.length("text")))), slice_chars)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        rows = items.filter(place == k).collect()
        yield Benchmark.of([(r["item_id"], r["text"]) for r in rows], min_match)


PAIRS_SCHEMA = (
    "doc_id long, item_id long, item_tokens int, covered_tokens int, coverage double, "
    "tiles array<struct<size:int,item_start:int,doc_start:int>>"
)


def tiled_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """One row per document and item with enough coverage, with the tiles (token places)."""
    texts = docs.select("doc_id", text_of().alias("text"))
    parts = []
    for part in _slices(benchmark, min_match, slice_chars):
        held = docs.sparkSession.sparkContext.broadcast(part)

        def compare(batches: Iterable[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            part = held.value
            for batch in batches:
                ids = batch["doc_id"].astype("Int64")
                rows = [
                    (ids.iloc[text], part.item_ids[k], len(part.items[k]), covered, covered / len(part.items[k]),
                     [{"size": s, "item_start": j, "doc_start": i} for s, j, i in tiles])
                    for text, k, covered, tiles in part.tiled(batch["text"], threshold)
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "item_id", "item_tokens", "covered_tokens", "coverage", "tiles"])
                yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        parts.append(texts.mapInPandas(compare, PAIRS_SCHEMA))
    return functools.reduce(DataFrame.unionByName, parts)


def _clean(held, threshold: float) -> Column:
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        keep = np.ones(len(text), bool)
        keep[[found[0] for found in held.value.tiled(text, threshold)]] = False
        return pd.Series(keep)

    return clean(text_of())


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """The documents that no item contaminates, rows and columns as they came."""
    kept = docs
    for part in _slices(benchmark, min_match, slice_chars):
        kept = kept.filter(_clean(docs.sparkSession.sparkContext.broadcast(part), threshold))
    return kept
