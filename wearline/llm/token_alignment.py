"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other.

A text is encoded whole by both: by a byte-level BPE as space + text, and by a
SentencePiece model, which puts that space before it itself. If the bytes of the
tokens of both are those of space + text, the places where a token of each ends
are verified shared ends. Those before a space-marked token are anchors: they cut
the document into windows, mostly one word each, whose token ids alone decide how
their tokens lie to each other. So a window is aligned once and remembered under
the tuple of its ids; a document is a row of remembered windows.

In a window, shared ends close groups, written ``a1,a2|b1`` and joined by ``;``.
Every stretch between two neighbouring ends, of either side, is one link: a pair
of tokens whose bytes overlap. The count of an id pair is the number of
documents that hold it linked; the pair is best for its first id if no other
pair of that id has a higher count. Documents keep their different pairs with
how often they hold them; pairs are counted and looked up by Spark. The
look-up table has a row for each pair that occurs: up to ``SENT_PAIRS`` rows it
is sent to the tasks, beyond that both sides are joined by pair.

In texts of usual signs and single spaces the windows are the words, whose tokens are
the same alone as in the text; there a repeated word leads to its window at once.
Any other text is encoded and cut as a whole. What is remembered of words and windows is bounded by ``MEMO_BYTES`` twice over, the older half being
forgotten when the newer one is full. New windows of a text are aligned together in
numpy; a text without spaces is a single window.

Edge cases: null and empty texts, and texts whose joined bytes differ on either
side (a text with U+2581, which SentencePiece writes for a space), have no tokens:
zeros and empty columns; strings of special tokens are plain text; null and
repeated doc_ids are rows of their own and documents of their own in the counts;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
from collections import Counter
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import text_of
from wearline.workspace import settle

SPACE = "▁"
MEMO_BYTES = 50_000_000
WORD_BYTES = 200  # of a remembered word
SENT_PAIRS = 1_000_000
ENTRY_BYTES = 350  # of a remembered window besides its ids, groups and links
# Fixed value: the pre-tokenizer's pattern that the byte-level vocabulary was made with.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts with other signs are encoded by the tokenizers library itself, whatever its Unicode tables.
_UNUSUAL = re.compile("[^\\n\\t\\r\\x20-\\x7e\\u00a1-\\u024f]")
# White space beside a space.
_SPACES = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")


class ByteLevel:
    """The byte-level vocabulary of a ``tokenizers`` file: ids of a text, bytes of an id."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, decoders

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        if stored["pre_tokenizer"] is None or stored["pre_tokenizer"]["type"] != "ByteLevel" or stored["normalizer"]:
            raise ValueError("not a plain byte-level vocabulary")
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        special = {t["id"] for t in stored["added_tokens"]}
        letters = _letters(decoders.ByteLevel())
        vocab = stored["model"]["vocab"]
        self.size = max([*vocab.values(), *special], default=-1) + 1
        self.bytes = [b""] * self.size
        for token, k in vocab.items():
            self.bytes[k] = b"".join(map(letters.__getitem__, token)) if k not in special else b""
        ranks = {self.bytes[k]: k for k in vocab.values() if k not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if _UNUSUAL.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _letters(decoder) -> dict[str, bytes]:
    """Bytes of the printable letters that byte-level vocabularies write."""
    found = {}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in set(shown))
    found |= {chr(b): bytes([b]) for b in shown}
    found |= {chr(256 + i): bytes([b]) for i, b in enumerate(hidden)}
    if decoder.decode([chr(256 + 32), "a"]) != " a":
        raise ValueError("the library writes bytes with other letters")
    return found


class PieceModel:
    """A SentencePiece model: ids of a text, bytes of an id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(self.size)]
        # No piece goes from a letter to a space, so words are encoded alike alone and in a text.
        self.by_word = all(SPACE not in name.lstrip(SPACE) for name in names)
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(k) else name.replace(SPACE, " ").encode()
            for k, name in enumerate(names)
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def _is_plain(text: str) -> bool:
    """Usual signs, and every space stands alone between two words: no token reaches over its left side."""
    return not (
        any(pair in text for pair in _SPACES) or text[0] == " " or text[-1] == " " or _UNUSUAL.search(text)
    )


class _Memo:
    """What is known of keys, in two halves: when the newer one is full the older one is forgotten."""

    def __init__(self, most: int):
        self.most, self.held = most, 0
        self.new: dict = {}
        self.old: dict = {}

    def look_up(self, keys: list) -> list:
        """Values in the order of the keys, None for unknown ones."""
        found = list(map(self.new.get, keys))
        if None in found:
            old, new = self.old.get, self.new
            for k in [k for k, value in enumerate(found) if value is None]:
                found[k] = value = old(keys[k])
                if value is not None:
                    new[keys[k]] = value
        return found

    def add(self, keys: list, values: list, size: int) -> None:
        if self.held > self.most:
            self.old, self.new, self.held = self.new, {}, 0
        self.new.update(zip(keys, values))
        self.held += size


class Aligner:
    """Aligns texts, each different window of token ids once.

    An alignment is (tokens of a, tokens of b, groups with a last ``;``, links as bytes of pair codes).
    """

    def __init__(self, a: ByteLevel, b: PieceModel, memo_bytes: int = MEMO_BYTES):
        self.a, self.b = a, b
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        self.spaced = np.array([x.startswith(b" ") for x in a.bytes])
        self.pairs_type = np.int32 if a.size * b.size < 2**31 else np.int64
        # Ids as they are shown, by what follows them: inside a side of a group, and at the end of each side.
        self.most = max(a.size, b.size)
        self.shown = [f"{k}{sign}" for sign in ",|;" for k in range(self.most)]
        self.words = _Memo(memo_bytes)
        self.known = _Memo(memo_bytes)

    def _spells(self, tokenizer: ByteLevel | PieceModel, ids: np.ndarray, plain: bytes) -> bool:
        return b"".join(map(tokenizer.bytes.__getitem__, ids.tolist())) == plain

    # --- windows of any text ----------------------------------------------------

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin and end in both rows of ids: at shared ends before a space, and at the end."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        anchors = np.append(np.flatnonzero(self.spaced[a[1:]]), len(a) - 1)
        at = np.searchsorted(ends_b, ends_a[anchors])
        verified = ends_b[at] == ends_a[anchors]
        return np.append(0, anchors[verified] + 1), np.append(0, at[verified] + 1)

    def _of_tokens(self, text: str) -> list[tuple] | None:
        """Alignments of the windows of a text, from all its tokens; None where a side does not spell it."""
        a, b = np.array(self.a.encode(" " + text), "<u4"), np.array(self.b.encode(text), "<u4")
        plain = (" " + text).encode()
        if not (self._spells(self.a, a, plain) and self._spells(self.b, b, plain)):
            return None
        return self._of_windows(a, b, *self.windows(a, b))

    def _of_windows(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[tuple]:
        """Alignments of windows by their tuples of ids; unknown ones are aligned together."""
        n_a, n_b = np.diff(cuts_a), np.diff(cuts_b)
        # Window after window: its ids of a, then its ids of b, moved up so that no two windows look alike.
        whole = np.empty(len(a) + len(b), "<u4")
        whole[np.arange(len(a)) + np.repeat(cuts_b[:-1], n_a)] = a
        whole[np.arange(len(b)) + np.repeat(cuts_a[1:], n_b)] = b + np.uint32(self.a.size)
        ids, cuts = whole.tobytes(), (4 * (cuts_a + cuts_b)).tolist()
        keys = [ids[start:stop] for start, stop in pairwise(cuts)]
        found = self.known.look_up(keys)
        if None in found:
            first: dict[bytes, int] = {}
            for k, window in enumerate(found):
                if window is None:
                    first.setdefault(keys[k], k)
            chosen = np.zeros(len(keys), bool)
            chosen[list(first.values())] = True
            new = self._align(a[np.repeat(chosen, n_a)], b[np.repeat(chosen, n_b)], n_a[chosen], n_b[chosen])
            fresh = dict(zip(first, new))
            found = [fresh[key] if window is None else window for key, window in zip(keys, found)]
            self.known.add(list(fresh), new, sum(ENTRY_BYTES + 4 * len(key) for key in fresh))
        return found

    def _align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[tuple]:
        """Alignments of new windows, given in a row with their numbers of tokens on each side."""
        # Both sides of a window are equally long, so ends of all windows in a row are comparable.
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.concatenate([ends_a, ends_b])
        ends.sort(kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = (a[at_a].astype(np.int64) * self.b.size + b[at_b]).astype(self.pairs_type)
        shared = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        # Tokens in the order in which groups show them: one side of a group, then the other.
        last_a, last_b = at_a[shared], at_b[shared]
        shown = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(np.append(0, last_b[:-1] + 1), np.diff(last_a, prepend=-1))
        place_b = np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        shown[place_a], shown[place_b] = a, b
        shown[place_a[last_a]] += self.most
        shown[place_b[last_b]] += 2 * self.most
        signs = list(map(self.shown.__getitem__, shown.tolist()))
        packed, width = links.tobytes(), links.itemsize
        stops = np.searchsorted(ends, ends_a[np.cumsum(n_a) - 1]) + 1
        of_tokens = pairwise([0, *np.cumsum(n_a + n_b).tolist()])
        of_links = pairwise([0, *(stops * width).tolist()])
        return [
            (x, y, "".join(signs[i:j]), packed[start:stop])
            for x, y, (i, j), (start, stop) in zip(n_a.tolist(), n_b.tolist(), of_tokens, of_links)
        ]

    # --- windows that are words -----------------------------------------------------

    def _of_words(self, words: list[str]) -> list[tuple] | None:
        """Alignments of a text of usual signs and single spaces: its words are its windows.

        No token of either side reaches over the left side of such a space, so words
        have their tokens alone as in the text, and a known word has a known window.
        """
        found = self.words.look_up(words)
        if None not in found:
            return found
        new = list({word for word, window in zip(words, found) if window is None})
        a = np.array(self.a.fast.encode_ordinary(" " + " ".join(new)), "<u4")
        pieces = self.b.model.encode(new, num_threads=1)
        b = np.fromiter(chain.from_iterable(pieces), "<u4")
        plain, starts = (" " + " ".join(new)).encode(), np.flatnonzero(self.spaced[a])
        if len(starts) != len(new) or not (self._spells(self.a, a, plain) and self._spells(self.b, b, plain)):
            return None
        cuts_b = np.append(0, np.cumsum(list(map(len, pieces))))
        aligned = dict(zip(new, self._of_windows(a, b, np.append(starts, len(a)), cuts_b)))
        self.words.add(new, list(aligned.values()), WORD_BYTES * len(new))
        return [aligned[word] if window is None else window for word, window in zip(words, found)]

    def __call__(self, text: str) -> tuple[int, int, str, np.ndarray, np.ndarray]:
        """Numbers of tokens, the groups, the different pairs and how often each is linked."""
        found = None
        if text and self.b.by_word and _is_plain(text):
            found = self._of_words(text.split(" "))
        if text and found is None:
            found = self._of_tokens(text)
        if not found:
            return 0, 0, "", np.zeros(0, self.pairs_type), np.zeros(0, np.int32)
        n_a, n_b, groups, _ = zip(*found)
        # Equal windows are one object, so each is taken once, with its number.
        times = Counter(map(id, found))
        windows = {id(window): window[3] for window in found}
        linked = np.frombuffer(b"".join(windows.values()), self.pairs_type)
        sizes = np.fromiter(map(len, windows.values()), np.int64, len(windows)) // linked.itemsize
        codes, at = np.unique(linked, return_inverse=True)
        times = np.bincount(at, np.repeat([times[k] for k in windows], sizes))
        return sum(n_a), sum(n_b), "".join(groups)[:-1], codes, times.astype(np.int32)


@functools.cache
def _aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(ByteLevel(a_file), PieceModel(b_file))


def pair_type(a_file: str, b_file: str) -> tuple[str, int]:
    """Type of pair codes and the factor of the first id in them."""
    aligner = _aligner(a_file, b_file)
    return ("int" if aligner.pairs_type is np.int32 else "long"), aligner.b.size


def alignments(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Per document ``n_a``, ``n_b``, ``groups``, and its different ``pairs`` with ``times``."""
    code, _ = pair_type(a_file, b_file)

    def align(batches):
        aligner = _aligner(a_file, b_file)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            # A part of the batch at a time: what is sent back is larger than the texts.
            start = size = 0
            for k in range(len(batch)):
                size += len(texts[k].as_buffer())
                if size > 4_000_000 or k == len(batch) - 1:
                    part = texts.slice(start, k + 1 - start).to_pylist()
                    columns = list(zip(*map(aligner, part)))
                    pairs, times = (pa.array(c, pa.list_(t)) for c, t in zip(columns[3:], (_arrow(code), pa.int32())))
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(start, len(part)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pairs, times],
                        ["doc_id", "n_a", "n_b", "groups", "pairs", "times"],
                    )
                    start, size = k + 1, 0

    schema = f"doc_id long, n_a long, n_b long, groups string, pairs array<{code}>, times array<int>"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(align, schema)


def _arrow(code: str) -> pa.DataType:
    return pa.int32() if code == "int" else pa.int64()


def pair_counts(aligned: DataFrame, factor: int) -> DataFrame:
    """``pair``, ``n`` documents that hold it linked, ``best``: no pair of its first id has more."""
    counts = settle(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs"
    ).withColumn("a", F.expr(f"pair div {factor}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``n_best`` and ``count_sum`` for stored rows that have a ``row`` number of their own."""
    counts = settle(counts, "pair-counts")
    table = F.broadcast(counts) if counts.count() <= sent_pairs else counts
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    held = held.select("row", F.col("held.pairs").alias("pair"), F.col("held.times").alias("times"))
    sums = held.join(table, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("times") * F.col("n")).cast("long").alias("count_sum"),
    )
    none = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return aligned.drop("pairs", "times").join(sums, "row", "left").withColumns(none)


def link_scores(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Per document the numbers of tokens, groups and links, how common its links are, and its groups' digest."""
    aligned = alignments(docs, a_file, b_file)
    groups, times = F.col("groups"), F.col("times")
    stored = settle(
        aligned.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_a",
            "n_b",
            F.when(groups == "", 0).otherwise(F.length(groups) - F.length(F.replace(groups, F.lit(";"))) + 1).cast("long").alias("n_groups"),
            F.aggregate(times, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_links"),
            F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"),
            "pairs",
            "times",
        ),
        "alignments",
    )
    counts = pair_counts(stored, pair_type(a_file, b_file)[1])
    return with_counts(stored, counts).drop("row")
