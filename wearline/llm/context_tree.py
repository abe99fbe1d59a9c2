"""Language-model scores by context-tree weighting over bytes.

A text is its words (runs of other bytes than ASCII white space, A-Z in lower
case) with a space after each but the last, and a line end, which is the end
token. Every byte is eight binary decisions; a decision is made at a *node*: the
bits of the byte so far and a context, the preceding bytes, up to ``DEPTH`` of
them (zero bytes before the start). Each node of each depth has a
Krichevsky-Trofimov estimate from its two counts. The probability of a decision
mixes the estimates of all depths along the context. The weight of a node
against its children is the posterior of context-tree weighting: half its own
block probability against half the product of what its children assign. Below
the deepest context seen in training, that context's estimate is used as it is.
Minus the logarithm of a byte's eight probabilities is its code length.

The model is as large as its corpus asks: counts, nodes and everything looked up
are spread over parts by a hash of the last ``SPLIT`` context bytes, so the tree
below each such context lies in one part. What is above, contexts shorter than
``SPLIT`` bytes, is at most 2**24 nodes however large the corpus, and is sent to
every task. No token or context table is ever held whole.

1. Texts are packed into batches of a few MB and written. Everything after works
   on batches.
2. The different (context, byte) grams of the training texts, with counts, move
   to their parts and are merged; the parts report the probabilities of their
   trees, from which the shared top is built.
3. Each batch sends its different grams and words to their parts, packed as one
   row per part, and gets log probabilities and word counts back in that order.
4. Batches and answers meet by batch number; texts add up what their bytes and
   words got.

So rows grow with what is different in a batch and not with its bytes, each text
moves once, and every step is recomputed from written tables if an executor goes.

The same pass gives the word-frequency base score: the sum over tokens of
``log10((c + 1) / (N + V + 1))``.

Edge cases: null and empty texts are the end token alone; null ids are trained
on and scored; repeated rows count and are scored each; without training texts
every decision has probability one half; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import fold, pieces, text_of
from wearline.llm.tokenhash import byte_class, token_hashes
from wearline.workspace import settle

DEPTH, SPLIT = 5, 3
FOLDS, HELD_OUT = 7, 2
BATCH_BYTES = 6_000_000
PART_BYTES = 24_000_000  # bytes of text per part of the model
GRAMS_HELD = 2_000_000
WORDS_KIND, GRAMS_KIND = 0, 1
WORD_BYTES = ~byte_class(b" \t\n\r\x0b\x0c")
END_KEY = np.uint64(0x1234567887654321)
_HALF = math.log(0.5)
STATS = -1

BATCH_SCHEMA = "batch long, ids array<long>, train array<boolean>, sizes array<long>, data binary"
SENT_SCHEMA = "kind int, part int, batch long, keys binary, counts binary"
ANSWER_SCHEMA = "batch long, kind int, part int, answers binary"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def canonical(text: str) -> bytes:
    return b" ".join(text.encode().lower().split()) + b"\n"


# --- grams, words and their parts ------------------------------------------


def grams(data: bytes, sizes: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For every byte, it and its context as one number, the byte lowest."""
    array = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    key = array.astype(np.int64)
    for k in range(1, depth + 1):
        shifted = np.zeros(len(array), np.int64)
        shifted[k:] = array[:-k]
        # Bytes of the text before are no context.
        for offset in range(k):
            at = starts + offset
            shifted[at[offset < sizes]] = 0
        key |= shifted << (8 * k)
    return key


def words(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, the end of each text among them, and the number of tokens of each text."""
    hashes, at = token_hashes(data, WORD_BYTES)
    ends = np.searchsorted(at, np.cumsum(sizes))
    return np.insert(hashes, ends, END_KEY).view(np.int64), np.diff(np.concatenate([[0], ends])) + 1


def _part(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    own = keys.view(np.uint64)
    if kind == GRAMS_KIND:
        own = (own >> np.uint64(8)) & np.uint64(2 ** (8 * SPLIT) - 1)
    with np.errstate(over="ignore"):
        own = (own + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        own ^= own >> np.uint64(29)
        own *= np.uint64(0xBF58476D1CE4E5B9)
    return ((own >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _in_parts(kind: int, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that puts sorted keys by part; the parts that occur; where each begins and ends."""
    part = _part(kind, keys, parts)
    order = np.argsort(part, kind="stable")
    present, first = np.unique(part[order], return_index=True)
    return order, present, np.append(first, len(keys))


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        return np.unique(keys, return_counts=True)
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, weights, len(unique)).astype(np.int64)


# --- the tree --------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series from 8 on."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


@dataclass
class Level:
    """Nodes of one depth: sorted keys (context, bits so far), estimates of a one, weights."""

    keys: np.ndarray
    ones: np.ndarray
    weight: np.ndarray
    block: np.ndarray  # log of the weighted block probability

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def _node(grams: np.ndarray, bit: int) -> np.ndarray:
    """Key of the node at which a bit of the gram's byte is decided."""
    return (grams >> 8 << 8) | (1 << bit) | ((grams & 255) >> (8 - bit))


def _counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nodes = np.concatenate([_node(keys, bit) for bit in range(8)])
    ones = np.concatenate([counts * ((keys >> (7 - bit)) & 1) for bit in range(8)])
    unique, place = np.unique(nodes, return_inverse=True)
    total = np.bincount(place, np.tile(counts, 8), len(unique))
    return unique, total, np.bincount(place, ones, len(unique))


def _parents(nodes: np.ndarray, depth: int) -> np.ndarray:
    """Keys of nodes after dropping the oldest byte of their contexts, to ``depth`` bytes."""
    return (((nodes >> 8) & ((1 << (8 * depth)) - 1)) << 8) | (nodes & 255)


def _level(keys: np.ndarray, counts: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None) -> Level:
    """One depth; ``below``: keys of its nodes, and the log probabilities of their children."""
    nodes, total, ones = _counts(keys, counts)
    own = log_gamma(total - ones + 0.5) + log_gamma(ones + 0.5) - log_gamma(total + 1.0) - math.log(math.pi)
    estimate = (ones + 0.5) / (total + 1.0)
    if below is None:
        return Level(nodes, estimate, np.ones(len(nodes)), own)
    children = np.bincount(np.searchsorted(nodes, below[0]), below[1], len(nodes))
    block = np.logaddexp(_HALF + own, _HALF + children)
    return Level(nodes, estimate, np.exp(_HALF + own - block), block)


def levels(
    keys: np.ndarray, counts: np.ndarray, low: int, high: int, below: tuple[np.ndarray, np.ndarray] | None = None
) -> dict[int, Level]:
    """Levels ``high`` down to ``low`` of the grams' tree."""
    found: dict[int, Level] = {}
    for depth in range(high, low - 1, -1):
        cut, n = _counted(keys & ((1 << (8 * (depth + 1))) - 1), counts)
        found[depth] = _level(cut, n, below)
        if depth:
            below = _parents(found[depth].keys, depth - 1), found[depth].block
    return found


def log_probabilities(keys: np.ndarray, tree: dict[int, Level]) -> np.ndarray:
    """Decimal logarithm of the probability of each gram's byte after its context."""
    total = np.zeros(len(keys))
    for bit in range(8):
        one = ((keys >> (7 - bit)) & 1).astype(bool)
        done, rest = np.zeros(len(keys)), np.ones(len(keys))
        final = np.full(len(keys), 0.5)
        for depth in sorted(tree):
            level = tree[depth]
            at, there = level.find(_node(keys & ((1 << (8 * (depth + 1))) - 1), bit))
            if not there.any():
                break
            p = np.where(one, level.ones[at], 1 - level.ones[at])
            w = level.weight[at]
            final = np.where(there, done + rest * p, final)
            done = np.where(there, done + rest * w * p, done)
            rest = np.where(there, rest * (1 - w), rest)
        total += np.log10(final)
    return total


# --- Spark jobs ------------------------------------------------------------


def _batches(docs: DataFrame) -> DataFrame:
    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        train: list[bool] = []
        data: list[bytes] = []
        held = 0

        def packed() -> pd.DataFrame:
            row = (number, list(ids), list(train), [len(d) for d in data], zlib.compress(b"".join(data), 1))
            return pd.DataFrame([row], columns=["batch", "ids", "train", "sizes", "data"])

        for batch in batches:
            for doc_id, trained, text in zip(batch["doc_id"].astype("Int64"), batch["train"], batch["text"]):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                train.append(bool(trained))
                data.append(canonical(text))
                held += len(data[-1])
                if held >= BATCH_BYTES:
                    yield packed()
                    ids, train, data, held, number = [], [], [], 0, number + 1
        if data:
            yield packed()

    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out).alias("train"), text_of().alias("text"))
    return settle(rows.mapInPandas(pack, BATCH_SCHEMA), "text-batches")


def _unpacked(row) -> tuple[bytes, np.ndarray, np.ndarray]:
    return zlib.decompress(row.data), np.asarray(row.sizes, np.int64), np.asarray(row.train, bool)


def _blobs(kind: int, parts: int, batch: int, keys: np.ndarray, counts: np.ndarray | None) -> pd.DataFrame:
    order, present, edges = _in_parts(kind, keys, parts)
    keys = keys[order]
    counts = None if counts is None else counts[order].astype("<i8")
    rows = [
        (kind, int(p), batch, keys[a:b].tobytes(), b"" if counts is None else _narrow(counts[a:b]))
        for p, a, b in zip(present, edges[:-1], edges[1:])
    ]
    return pd.DataFrame(rows, columns=["kind", "part", "batch", "keys", "counts"])


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in 4 bytes each, or 8 where one needs them."""
    return counts.astype("<u4" if not len(counts) or counts.max() < 2**32 else "<i8").tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, "<i8" if size and len(data) == 8 * size else "<u4").astype(np.int64)


def _keys(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _merged(blobs: Iterable[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    found = [(_keys(k), _wide(c, len(k) // 8)) for k, c in blobs]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _counted(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))


def _training_grams(batches: DataFrame, parts: int) -> DataFrame:
    """Grams of the training texts with their counts, one row per part."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            for row in frame.itertuples():
                data, sizes, train = _unpacked(row)
                own, n = _counted(grams(data, sizes)[np.repeat(train, sizes)])
                keys, counts = _counted(np.concatenate([keys, own]), np.concatenate([counts, n]))
                if len(keys) > GRAMS_HELD:
                    yield _blobs(GRAMS_KIND, parts, 0, keys, counts)
                    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(keys):
            yield _blobs(GRAMS_KIND, parts, 0, keys, counts)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(zip(rows["keys"], rows["counts"]))
        row = (GRAMS_KIND, int(rows["part"].iloc[0]), 0, keys.tobytes(), _narrow(counts))
        return pd.DataFrame([row], columns=["kind", "part", "batch", "keys", "counts"])

    sent = batches.mapInPandas(count, SENT_SCHEMA)
    return settle(sent.groupBy("part").applyInPandas(merge, SENT_SCHEMA), "training-grams")


def _top(model: DataFrame) -> dict[int, Level]:
    """The levels above ``SPLIT``, from sums over the parts: at most 2**24 rows of each kind."""

    def report(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                keys, counts = _merged([(row.keys, row.counts)])
                tree = levels(keys, counts, SPLIT, DEPTH)
                short, n = _counted(keys & ((1 << (8 * SPLIT)) - 1), counts)
                parents, place = np.unique(_parents(tree[SPLIT].keys, SPLIT - 1), return_inverse=True)
                sums = np.bincount(place, tree[SPLIT].block, len(parents))
                yield pd.DataFrame({"node": False, "key": short, "value": n.astype(float)})
                yield pd.DataFrame({"node": True, "key": parents, "value": sums})

    rows = model.select("keys", "counts").mapInPandas(report, "node boolean, key long, value double")
    sums = rows.groupBy("node", "key").agg(F.sum("value").alias("value")).toArrow().to_pandas()
    short, nodes = sums[~sums["node"]].sort_values("key"), sums[sums["node"]]
    below = nodes["key"].to_numpy(np.int64), nodes["value"].to_numpy(float)
    return levels(short["key"].to_numpy(np.int64), short["value"].to_numpy(np.int64), 0, SPLIT - 1, below)


def _answers(batches: DataFrame, model: DataFrame, parts: int) -> DataFrame:
    """For every batch and part: word counts or log probabilities, in the order that was sent."""
    top = batches.sparkSession.sparkContext.broadcast(_top(model))

    def ask(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                data, sizes, train = _unpacked(row)
                yield _blobs(GRAMS_KIND, parts, row.batch, np.unique(grams(data, sizes)), None)
                tokens, per_text = words(data, sizes)
                own = np.unique(tokens)
                trained, n = _counted(tokens[np.repeat(train, per_text)])
                counts = np.zeros(len(own), np.int64)
                counts[np.searchsorted(own, trained)] = n
                yield _blobs(WORDS_KIND, parts, row.batch, own, counts)

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["batch", "kind", "part", "answers"])
        kind, part = int(asked["kind"].iloc[0]), int(asked["part"].iloc[0])
        keys = [_keys(k) for k in asked["keys"]]
        edges = np.cumsum([0, *map(len, keys)])
        unique, place = np.unique(np.concatenate(keys), return_inverse=True)
        extra = []
        if kind == WORDS_KIND:
            counts = np.concatenate([_wide(c, len(k)) for c, k in zip(asked["counts"], keys)])
            total = np.bincount(place, counts, len(unique)).astype(np.int64)
            stats = np.array([total.sum(), (total > 0).sum()], "<i8").tobytes()
            extra = [(STATS, kind, part, stats)]
            shown = [_narrow(total[place[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
        else:
            grams_of = _merged(zip(known["keys"], known["counts"]))
            tree = top.value | levels(*grams_of, SPLIT, DEPTH)
            values = log_probabilities(unique, tree).astype("<f4")
            shown = [values[place[a:b]].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        rows = [(int(b), kind, part, s) for b, s in zip(asked["batch"], shown)] + extra
        return pd.DataFrame(rows, columns=["batch", "kind", "part", "answers"])

    key = ["kind", "part"]
    asked = batches.mapInPandas(ask, SENT_SCHEMA)
    found = asked.groupBy(*key).cogroup(model.groupBy(*key)).applyInPandas(answer, ANSWER_SCHEMA)
    return settle(found, "answers")


def _score(batch: pd.DataFrame, answers: pd.DataFrame, parts: int) -> pd.DataFrame:
    names = [c.split()[0] for c in SCORE_SCHEMA.split(", ")]
    if not len(batch):
        return pd.DataFrame(columns=names)
    row = next(batch.itertuples())
    data, sizes, train = _unpacked(row)

    def values(kind: int, keys: np.ndarray) -> np.ndarray:
        """Answers for keys in any order."""
        unique, place = np.unique(keys, return_inverse=True)
        order, present, edges = _in_parts(kind, unique, parts)
        own = answers[answers["kind"] == kind].set_index("part")["answers"]
        found = np.zeros(len(unique))
        for p, a, b in zip(present, edges[:-1], edges[1:]):
            got = own.at[int(p)]
            found[order[a:b]] = np.frombuffer(got, "<f4") if kind == GRAMS_KIND else _wide(got, b - a)
        return found[place]

    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    score = np.add.reduceat(values(GRAMS_KIND, grams(data, sizes)), starts)
    tokens, per_text = words(data, sizes)
    counts = values(WORDS_KIND, tokens)
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if i is None or i != i else int(i) for i in row.ids], "Int64"),
            "held_out": ~train,
            "n_tokens": per_text,
            "n_known": np.add.reduceat((counts > 0).astype(np.int64), first),
            "base": np.add.reduceat(np.log10(counts + 1), first),
            "score": score,
        }
    )


def scores(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    and ``score`` (decimal logarithms) of every document."""
    batches = _batches(docs)
    size = batches.select(F.explode("sizes").alias("n")).agg(F.sum("n")).first()[0]
    parts = pieces(size, part_bytes)
    model = _training_grams(batches, parts)
    answers = _answers(batches, model, parts)
    totals = np.zeros(2, np.int64)
    for row in answers.filter(F.col("batch") == STATS).select("answers").toLocalIterator():
        totals += np.frombuffer(row["answers"], "<i8")
    tokens, vocabulary = map(int, totals)

    pair = batches.groupBy("batch").cogroup(answers.filter(F.col("batch") != STATS).groupBy("batch"))
    found = pair.applyInPandas(lambda left, right: _score(left, right, parts), SCORE_SCHEMA)
    base = F.col("base") - F.col("n_tokens") * math.log10(tokens + vocabulary + 1)
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
