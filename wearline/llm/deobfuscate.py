"""Toxicity scores of texts whose words may be disguised (noisy-channel restoration).

A suspicious run of characters is a lattice: a leetspeak sign may stand for a
letter or be dropped at an edge, a repeated letter for one or two, a separator
between single characters for nothing or for a word break. A Viterbi search over
the lattice, with the last two letters as state, finds the likeliest reading
under a trigram language model of letters times the costs of the disguises.
Words without any of this have one reading and skip the search. A run without a
letter is read too if it has such signs ("@$$", "455"), and its reading counts
if its letters are likelier than random ones, which most plain numbers' are not.
A word that separators split is read joined as well as in parts.

Model, all of it fitted here from the tables:

* letters: trigram counts over all texts (28 classes: word edge, a to z, other
  letters; 21,952 counts whatever the input size);
* lexicon: for the distinct labelled texts outside the held-out fold, in how
  many texts of each label a restored word occurs, and the same summed up over
  the words that share their first 3 to 6 letters.
  Features that lean to label 1 far beyond chance are kept, all of them unless
  ``lexicon_size`` (a documented parameter) asks for the best ones only;
* score: each distinct restored word adds the weight of its best feature, and a
  logistic curve with two parameters, fitted on counts of binned sums, turns the
  total into a probability.

Nothing but the text decides a score. The held-out fold is ``crc32`` of the id
as text, modulo ``folds``, equal to 0; its labels are never read.

Edge cases: null and empty texts get the score of a text without any listed
word; null ids and labels are not learned from; texts with conflicting labels
count for both; without labels of both kinds all scores are the share of label 1
(0 without labels). Extra columns do not matter here and stay in ``clean``.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.llm.common import fold, text_of
from wearline.workspace import settle

FOLDS = 5
CLASSES = 28
OTHER = 27
MIN_TEXTS = 5
MIN_WEIGHT = 1.5
MIN_EVIDENCE = 30.0  # twice the log-likelihood ratio
SENT_IDS = 1_000_000  # labelled texts up to which their ids (16 bytes each) are sent to all tasks
BIN = 0.25
BINS = 200

# Letters that signs stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c",
}
SIGN_COST, DROP_COST, SPACE_COST, DOUBLE_COST = 1.5, 0.7, 1.0, 1.0
_EDGES = ".,;:!?\"'()[]{}«»„“”…-*_%&#"
_SPACED = re.compile(r"(?<!\S)[^\W_](?:[ .\-_*|/][^\s.\-_*/]){2,}(?!\S)|(?<!\S)[^\s\w](?:[ .\-_*/][^\W_]){2,}(?!\S)")
_DOUBLED = re.compile(r"(.)\1+")
_TRIPLE = re.compile(r"(.)\1\1")


def _class_of(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 0 if letter == " " else OTHER


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123] = np.arange(1, 27)
    table[0xC0:] = OTHER  # the first byte of a character beyond ASCII
    return table


_BYTE_CLASSES = _byte_classes()


def trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """Counts of three classes in a row; edges between words are one class, never two in a row."""
    total = np.zeros(CLASSES**3, np.int64)
    for text in texts:
        data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
        kinds = _BYTE_CLASSES[data[(data < 0x80) | (data >= 0xC0)]]
        keep = np.ones(len(kinds), bool)
        keep[1:] = (kinds[1:] != 0) | (kinds[:-1] != 0)
        kinds = kinds[keep]
        if len(kinds) > 2:
            places = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
            total += np.bincount(places, minlength=CLASSES**3)
    return total


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a class after two others, with lower orders mixed in."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(2, keepdims=True) + 5)
    # A letter at the start of a word depends on the edge alone, as its state holds no word before.
    p3[:, 0, :] = p2[0]
    return np.log(p3).reshape(-1)


def lattice(text: str, signs: bool = False) -> list[list[tuple[str, float]]]:
    """Readings of each run of equal characters, with their costs.

    With ``signs``, every sign stands for a letter and two for two: nothing else
    says what a text without letters is.
    """
    runs = [(c, len(list(g))) for c, g in itertools.groupby(text)]
    found = []
    for k, (c, n) in enumerate(runs):
        edge = k in (0, len(runs) - 1)
        if c in LEET:
            letters = LEET[c]
            options = [(x, SIGN_COST) for x in letters]
            if n > 1:
                options += [(x + x, SIGN_COST + (DOUBLE_COST if n > 2 else 0.0)) for x in letters]
            if signs and n == 2:
                options = options[len(letters) :]
            if not c.isdigit() and not signs:
                options.append(("", DROP_COST if edge else 2 * DROP_COST))
        elif c.isalpha():
            options = [(c, 0.0 if n != 2 else DOUBLE_COST)]
            if n > 1:
                options.append((c + c, 0.0 if n == 2 else DOUBLE_COST))
        elif c == " ":
            options = [("", DROP_COST), (" ", SPACE_COST)]
        else:
            options = [("", 0.0)]
        found.append(options)
    return found


def viterbi(options: Sequence[Sequence[tuple[str, float]]], model: Sequence[float]) -> str:
    """The likeliest reading; of equal ones the first in alphabetical order."""
    # state (class before last, last class): (cost, reading)
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for choices in options:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, reading) in states.items():
            for letters, price in choices:
                total, x, y = cost + price, a, b
                for letter in letters:
                    c = _class_of(letter)
                    if c or y:
                        total -= model[(x * CLASSES + y) * CLASSES + c]
                        x, y = y, c
                candidate = (total, reading + letters)
                if (x, y) not in after or candidate < after[x, y]:
                    after[x, y] = candidate
        states = after
    ends = [
        (cost - (model[(a * CLASSES + b) * CLASSES] if b else 0.0), reading)
        for (a, b), (cost, reading) in states.items()
    ]
    return min(ends)[1].strip()


def features(word: str) -> list[str]:
    """The whole word (marked by its end) and its first letters."""
    return [word + "$", *(word[:n] for n in range(3, 7) if len(word) >= n)]


@dataclass
class Reader:
    """Restores the words of texts; remembers what it has read."""

    model: Sequence[float]
    weights: Mapping[str, float] = field(default_factory=dict)
    most: int = 200_000
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)
    scored: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.model = list(self.model)
        self.heads = {f[:3] for f in self.weights}

    def _likely(self, reading: str) -> bool:
        """Whether the letter model prefers a reading to random letters."""
        classes = [0, 0, *map(_class_of, reading), 0]
        places = ((a * CLASSES + b) * CLASSES + c for a, b, c in zip(classes, classes[1:], classes[2:]))
        # A start edge follows nothing, so the first place is the first letter's.
        return sum(self.model[p] for p in places) > -math.log(CLASSES) * (len(reading) + 1)

    def restore(self, text: str) -> str:
        return viterbi(lattice(text), self.model)

    def read(self, chunk: str) -> tuple[str, ...]:
        """Restored words of a lower-case run of characters without white space."""
        found = self.known.get(chunk)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[chunk] = found = self._read(chunk)
        return found

    def _read(self, chunk: str) -> tuple[str, ...]:
        word = chunk.strip(_EDGES)
        if word.isalpha() and not _TRIPLE.search(word):
            return (word,)
        if not any(c.isalpha() for c in word):
            if not any(c in LEET for c in word):
                return ()
            read = viterbi(lattice(word, signs=True), self.model)
            return (read,) if len(read) > 2 and self._likely(read) else ()
        parts = [p for p in re.split(r"[^\w@$!|+€£(<]+", word) if any(c.isalpha() for c in p)]
        return tuple(dict.fromkeys(r for r in (self.restore(word), *map(self.restore, parts)) if r))

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        text = text.lower()
        found = {w for chunk in set(text.split()) for w in self.read(chunk)}
        for match in _SPACED.finditer(text):
            spaced = re.sub(r"[ .\-_*|/]", " ", match[0])
            found.update(self.restore(spaced).split())
        return found

    def weight(self, word: str) -> float:
        """The weight of the word's best feature; a doubled letter may be one too many."""
        best = max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)
        if not best and _DOUBLED.search(word):
            single = _DOUBLED.sub(r"\1", word)
            if any(f in self.weights for f in features(single)):
                read = self.restore(_DOUBLED.sub(r"\1\1\1", word))
                best = max((self.weights.get(f, 0.0) for f in features(read)), default=0.0)
        return best

    def _scored(self, chunk: str) -> tuple[str, ...]:
        """The words of a chunk if one has a weight; plain words are told by their first letters.

        Of a split word the joined reading or the parts count, whichever weigh more.
        """
        word = chunk.strip(_EDGES)
        if len(word) > 2 and word.isalpha():
            if word[:3] not in self.heads and word[0] != word[1] != word[2]:
                return ()
        joined, *parts = self._read(chunk) or ("",)
        weights = [*map(self.weight, parts)]
        whole = self.weight(joined) if joined else 0.0
        if whole >= sum(weights):
            return (joined,) if whole else ()
        return tuple(parts)

    def total(self, text: str) -> float:
        """Sum of the weights of the distinct restored words."""
        text = text.lower()
        scored, found = self.scored, []
        for chunk in set(text.split()):
            value = scored.get(chunk)
            if value is None:
                if len(scored) >= self.most:
                    scored.clear()
                scored[chunk] = value = self._scored(chunk)
            found += value
        for match in _SPACED.finditer(text):
            found += self.restore(re.sub(r"[ .\-_*|/]", " ", match[0])).split()
        # The same order at every run, as sums of floating numbers depend on it.
        return sum(map(self.weight, sorted(set(found)))) if found else 0.0


# --- fitting ---------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityModel:
    letters: np.ndarray
    weights: dict[str, float]
    slope: float
    offset: float

    def score(self, totals: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(F.lit(self.slope) * totals + F.lit(self.offset))))


def _letter_counts(docs: DataFrame) -> np.ndarray:
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            total += trigram_counts(batch["text"])
        yield pd.DataFrame({"counts": [total]})

    rows = (
        docs.select(text_of().alias("text"))
        .mapInPandas(count, "counts array<long>")
        .select(F.posexplode("counts").alias("place", "n"))
        .groupBy("place")
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
        .collect()
    )
    total = np.zeros(CLASSES**3, np.int64)
    for row in rows:
        total[row["place"]] = row["n"]
    return total


def _training_texts(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """Distinct labelled texts outside the held-out fold: ``text``, ``toxic``.

    Copies are found on hashes; texts are joined only once for the chosen ids.
    """
    outside = fold("doc_id", folds) != 0
    known = labels.filter(outside & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    hashed = docs.filter(outside).select("doc_id", F.xxhash64(text_of()).alias("h"), F.length(text_of()).alias("n"))
    chosen = hashed.join(known, "doc_id").groupBy("h", "n", "toxic").agg(F.min("doc_id").alias("doc_id"))
    chosen = settle(chosen.select("doc_id", "toxic"), "labelled-texts")
    # Texts stay where they are while the chosen ids are few; beyond that both sides move by id.
    if chosen.count() <= SENT_IDS:
        chosen = F.broadcast(chosen)
    texts = docs.filter(outside).select("doc_id", text_of().alias("text"))
    return texts.join(chosen, "doc_id").select("text", "toxic")


def _lexicon(train: DataFrame, letters: np.ndarray, ones: int, zeros: int, size: int | None) -> dict[str, float]:
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(letters)
        counts: dict[int, Counter] = defaultdict(Counter)
        held = 0

        def flushed() -> pd.DataFrame:
            names = list(set(counts[0]) | set(counts[1]))
            return pd.DataFrame(
                {"word": pd.Series(names, dtype=object), "zeros": [counts[0][x] for x in names], "ones": [counts[1][x] for x in names]}
            )

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                counts[int(toxic)].update(reader.words(text))
                held += len(text)
                if held > 6_000_000:
                    yield flushed()
                    counts.clear()
                    held = 0
        if held:
            yield flushed()

    a, b = F.col("ones"), F.col("zeros")
    rate = (a + b) / F.lit(float(ones + zeros))

    def surprise(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    evidence = 2 * (surprise(a, rate * ones) + surprise(b, rate * zeros))
    # Of a word, the features that ``features`` gives.
    marks = F.concat(
        F.array(F.concat("word", F.lit("$"))),
        *(F.when(F.length("word") >= n, F.array(F.substring("word", 1, n))).otherwise(F.array()) for n in range(3, 7)),
    )
    weight = F.log(((a + 0.5) / (ones + 1.0)) / ((b + 0.5) / (zeros + 1.0)))
    chosen = (
        train.mapInPandas(count, "word string, zeros long, ones long")
        .select(F.explode(marks).alias("feature"), "zeros", "ones")
        .groupBy("feature")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
        .filter(a >= MIN_TEXTS)
        .select("feature", evidence.alias("evidence"), weight.alias("weight"))
        .filter((F.col("weight") >= MIN_WEIGHT) & (F.col("evidence") >= MIN_EVIDENCE))
        .orderBy(F.desc("evidence"), "feature")
    )
    rows = (chosen if size is None else chosen.limit(size)).collect()
    return {r["feature"]: r["weight"] for r in rows}


def totals_column(docs_text: Column, letters: np.ndarray, weights: Mapping[str, float]) -> Column:
    @F.pandas_udf("double")
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(letters, weights)
        for texts in batches:
            yield texts.map(reader.total).astype(float)

    return total(docs_text)


def _curve(bins: Sequence[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned totals, lightly regularised."""
    x = np.array([t for t, _, _ in bins])
    y = np.array([[one, zero] for _, zero, one in bins], float).reshape(-1, 2)
    ones, zeros = y[:, 0].sum(), y[:, 1].sum()
    if not ones or not zeros:
        share = ones / max(1.0, ones + zeros)
        return 0.0, math.log((share + 1e-6) / (1 - share + 1e-6))
    w = np.array([0.5, math.log(ones / zeros)])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        n = y.sum(1)
        gradient = design.T @ (y[:, 0] - n * p) - 0.01 * w
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, lexicon_size: int | None = None) -> ToxicityModel:
    letters = letter_model(_letter_counts(docs))
    train = _training_texts(docs, labels, folds)
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    weights = _lexicon(train, letters, ones, zeros, lexicon_size) if ones and zeros else {}
    place = F.least(F.floor(totals_column(F.col("text"), letters, weights) / BIN), F.lit(BINS))
    rows = train.select(place.alias("place"), "toxic").groupBy("place", "toxic").count().collect()
    bins: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for row in rows:
        bins[row["place"]][row["toxic"]] += row["count"]
    slope, offset = _curve([((k + 0.5) * BIN if k else 0.0, *n) for k, n in sorted(bins.items())])
    return ToxicityModel(letters, weights, slope, offset)


def score(docs: DataFrame, model: ToxicityModel, folds: int = FOLDS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    total = totals_column(text_of(), model.letters, model.weights)
    held_out = F.coalesce(fold("doc_id", folds) == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score(total).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents scored below one half, rows and columns as they came."""
    return docs.filter(model.score(totals_column(text_of(), model.letters, model.weights)) < 0.5)
