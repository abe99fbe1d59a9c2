"""Token ids in fixed-width bits: encode, pack into blocks, read any document back.

Ids are stored with the fewest bits that hold every id of the vocabulary. A
block is one binary value that describes itself::

    magic "FWB1" | width u8 | documents u32 | ids u64 |
    document ids i64[n] | offsets u64[n + 1] | packed ids | 8 zero bytes

``offsets`` count ids from the start of the block, so a document's bits start at
``offset * width``. Reading id ``i`` takes the 8 bytes at ``i * width // 8``,
one shift and one mask; numpy does that for a whole block at once and equally
for one document. A block closes when it holds ``BLOCK_IDS`` ids; documents are
never cut, so a longer one has a block of its own.

Blocks are the rows of a Parquet table in the shared folder (columns ``shard``,
``block``, ``first_id``, ``n_ids``, ``min_doc``, ``max_doc``, ``data``). Spark's
writer commits whole tasks, so a lost executor leaves no half shard, any store
that Spark writes will do, and the statistics of ``min_doc`` and ``max_doc``
limit a lookup to the blocks that can hold a document.

Edge cases: a null text is empty and has the end id alone; a null document id
is kept (written as the smallest 64-bit number, first in order); repeated rows
are documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import text_of

MAGIC = b"FWB1"
HEADER = struct.Struct("<4sBIQ")
BLOCK_IDS = 65_536
NULL_ID = -(2**63)
BLOCK_SCHEMA = (
    "shard int, block int, first_id long, n_ids long, min_doc long, max_doc long, data binary"
)

# --- bits ------------------------------------------------------------------


def bit_width(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as a little-endian bit string of ``width`` bits each."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if ids.size and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a bit string that 8 more bytes follow."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}")[start:stop].astype(np.uint32)
    place = np.arange(start, stop, dtype=np.int64) * width
    if not place.size:
        return np.zeros(0, np.uint32)
    first = int(place[0] >> 3)
    window = np.frombuffer(data, np.uint8)[first : int(place[-1] >> 3) + 8]
    words = np.lib.stride_tricks.sliding_window_view(window, 8)[(place >> 3) - first]
    words = np.ascontiguousarray(words).view("<u8").reshape(-1)
    mask = np.uint64((1 << width) - 1)
    return ((words >> (place & 7).astype(np.uint64)) & mask).astype(np.uint32)


def write_block(doc_ids: Sequence[int], arrays: Sequence[np.ndarray], width: int) -> bytes:
    lengths = np.array([len(a) for a in arrays], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    ids = np.concatenate(arrays) if len(arrays) else np.zeros(0, np.uint32)
    return b"".join(
        (
            HEADER.pack(MAGIC, width, len(doc_ids), len(ids)),
            np.asarray(doc_ids, "<i8").tobytes(),
            offsets.tobytes(),
            pack(ids, width),
            bytes(8),
        )
    )


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray, "functools.partial[np.ndarray]"]:
    """Document ids, offsets, and a function that unpacks ids from one place to another."""
    magic, width, documents, _ = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of packed ids")
    at = HEADER.size
    doc_ids = np.frombuffer(data, "<i8", documents, at)
    offsets = np.frombuffer(data, "<u8", documents + 1, at + 8 * documents).astype(np.int64)
    packed = memoryview(data)[at + 16 * documents + 8 :]  # with the zero bytes, for the last window
    return doc_ids, offsets, functools.partial(unpack, packed, width)


# --- the tokenizer ---------------------------------------------------------

# The pre-tokenizer's pattern and normalisation in the vocabulary file.
_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# Texts with anything else (controls, other scripts, special tokens) go to the library whole.
_UNUSUAL = re.compile("[^\\n\\t\\r\\x20-\\x7e\\u00a1-\\u024f]|<\\||\\u0130")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Remembered(dict):
    """Ids, as bytes, of parts of texts, each worked out once; of too many, those asked for lately stay."""

    def __init__(self, find: Callable[[str], bytes], most: int):
        super().__init__()
        self.find, self.half = find, most // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.find(part)
        if len(self) >= self.half:
            self.older.clear()
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids


class _Unusual(Exception):
    """A word that is left to the library, with its whole text."""


class Encoder:
    """Encodes texts as the library does, each different word and pre-token once.

    Texts repeat their words, and no pre-token holds white space. So a text is
    cut at its blanks and line ends; only unseen words are normalised and split
    here, and only unseen pre-tokens reach the library's model. A pre-token is a
    word of its own, so one store, with a bound, holds both. A text with a
    word of anything but common Latin signs is encoded by the library as it is.
    ``tests/llm`` compares both.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.split = regex.compile(_TOKENS).findall
        self.words = _Remembered(self._word, remembered)

    def _token(self, token: str) -> bytes:
        shown = token if token.isascii() else "".join(map(self.letters.get, token.encode()))
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        plain = word
        if not word.isascii() or not word.isalpha():
            if _UNUSUAL.search(word):
                raise _Unusual
            plain = unicodedata.normalize("NFC", word)
        plain = plain.lower()
        if plain.isalpha():
            found = [plain]
        elif plain[:-1].isalpha() and plain[-1] in ".,":
            found = [plain[:-1], plain[-1]]
        else:
            found = self.split(plain)
        if found == [word]:  # a pre-token
            return self._token(word)
        return b"".join(map(self.words.__getitem__, found))

    def __call__(self, text: str) -> np.ndarray:
        # Blanks by hand: ``split()`` would also cut at rare ones, whose texts are the library's.
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        try:
            return np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<u4")
        except _Unusual:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, np.uint32)


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# --- Spark jobs ------------------------------------------------------------


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary_file: str,
    vocabulary: int,
    end_id: int | None,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``doc_id``, ``text`` rows and write them as blocks in document order.

    One range exchange puts texts in order of their id; each task then encodes
    and packs its range as one shard, holding one block at a time.
    """
    width = bit_width(vocabulary)
    ordered = (
        docs.select(F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias("doc_id"), text_of().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def encode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary_file)
        shard = TaskContext.get().partitionId()
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        doc_ids: list[int] = []
        arrays: list[np.ndarray] = []
        first = held = block = 0

        def closed() -> pd.DataFrame:
            row = (shard, block, first, held, doc_ids[0], doc_ids[-1])
            data = write_block(doc_ids, arrays, width)
            return pd.DataFrame([(*row, data)], columns=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([encoder(text), tail])
                doc_ids.append(int(doc_id))
                arrays.append(ids)
                held += len(ids)
                if held >= block_ids:
                    yield closed()
                    first, held, block = first + held, 0, block + 1
                    doc_ids, arrays = [], []
        if doc_ids:
            yield closed()

    ordered.mapInPandas(encode, BLOCK_SCHEMA).write.parquet(folder)


def blocks_of(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``start``, the number of ids before each in the whole output.

    Positions inside a shard are stored; only one total per shard is summed up.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("__n"))
    shards = shards.select("shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # One row per task of the writing job, however long the texts are: small enough to send.
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("__before") + F.col("first_id")).drop("__before")


def read_ids(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """Documents from the blocks: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian 32 bit).

    With ``doc_ids``, only blocks whose range can hold one of them are read and
    only those documents are unpacked.
    """
    blocks = blocks_of(spark, folder)
    wanted = None if doc_ids is None else sorted(set(doc_ids))
    if wanted is not None:
        ranges = [F.lit(i).between(F.col("min_doc"), F.col("max_doc")) for i in wanted]
        blocks = blocks.filter(functools.reduce(lambda a, b: a | b, ranges, F.lit(False)))

    def documents(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, data in zip(batch["start"], batch["data"]):
                ids, offsets, part = read_block(data)
                chosen = np.arange(len(ids))
                if wanted is not None:
                    chosen = np.flatnonzero(np.isin(ids, wanted))
                if wanted is None:
                    whole = memoryview(part(0, int(offsets[-1])).astype("<u4").tobytes())
                    rows = [bytes(whole[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
                else:
                    rows = [part(int(offsets[i]), int(offsets[i + 1])).astype("<u4").tobytes() for i in chosen]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(ids[chosen], "Int64"),
                        "start": start + offsets[chosen],
                        "n_tokens": offsets[chosen + 1] - offsets[chosen],
                        "ids": rows,
                    }
                )

    found = blocks.select("start", "data").mapInPandas(
        documents, "doc_id long, start long, n_tokens long, ids binary"
    )
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


