"""SentencePiece encoding and decoding with a numpy Viterbi over many words at once.

The model file gives pieces and scores; nothing is trained here. A text is
escaped as the model says (a space becomes U+2581, one is put in front) and cut
into words where no piece can cross: a piece holds U+2581 only at its start.
Arrow numbers the words of a run of texts, and each different word is segmented
once; the ids of all its places are then laid out together. Words of equal length form a
matrix of code points and advance together, one position at a time: polynomial
prefix hashes give the hash of every substring, a small filter and a binary
search in the sorted hashes of the pieces of that length give its score, and one
maximum over the lengths of the last piece gives the best score and the last
piece of a whole column. All words go back together. Of equal scores the longest last piece wins. A character that no piece
matches costs more than any piece and is written as its UTF-8 bytes.

The result is the segmentation with the highest sum of scores, the definition
of unigram models. A merge-trained model file is read the same way, its scores
taken as they are; its own library would replay merges and may cut a word
otherwise, but both decode to the same text (see README).

Decoding joins the bytes of the pieces and undoes the escapes. It returns the
text exactly, but for U+2581 in the input, which is the escape itself and comes
back as a space, and undefined (surrogate) characters, which Spark never holds.

Edge cases: null and empty texts have no pieces; a word of any length is one
row of its own matrix; repeated rows are encoded alike; extra columns stay.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from wearline.llm.common import spread, text_of

SPACE = "▁"
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNKNOWN_PENALTY = 10.0
CELLS = 2_000_000  # substring scores held at once
REMEMBERED = 400_000  # words whose ids are kept for later texts
RUN_CHARS = 2_000_000  # of texts encoded together
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_SHIFT = np.uint64(46)
_NOTHING = -2
# Signs that may part the words of texts that do not hold them.
_MARKS = [*map(chr, range(9)), *map(chr, range(0xE000, 0x110000, 97))]
# A control character that is no piece stands alone, which bounds words in text without spaces.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall


def _hashes(points: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of code points, modulo 2**64."""
    prefix = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    mixed = (points.astype(np.uint64) + np.uint64(0x165667B1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(31)
    for k in range(points.shape[1]):
        prefix[:, k + 1] = prefix[:, k] * _BASE + mixed[:, k]
    return prefix


def _points(words: Sequence[str]) -> np.ndarray:
    text = "".join(words).encode("utf-32-le")
    return np.frombuffer(text, "<u4").reshape(len(words), -1)


class Pieces:
    """Pieces of one model, sorted for probing by length."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model asks for a text normalisation that is not supported")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.remembered = remembered
        by_length: dict[int, list[tuple[str, int, float]]] = defaultdict(list)
        self.byte_ids: dict[int, int] = {}
        self.plain: list[bytes] = []
        self.surface: dict[str, int] = {}
        scores = [p.score for p in model.pieces if p.type == NORMAL]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = 0
        for k, p in enumerate(model.pieces):
            plain = b""
            if p.type == NORMAL:
                if SPACE in p.piece.lstrip(SPACE) or "\n" in p.piece and len(p.piece) > 1:
                    raise ValueError("a piece crosses words")
                by_length[len(p.piece)].append((p.piece, k, p.score))
                self.surface[p.piece] = k
                plain = p.piece.replace(SPACE, " ").encode()
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = k
                plain = bytes([int(p.piece[3:-1], 16)])
            elif p.type == UNKNOWN:
                self.unknown_id = k
                plain = " ⁇ ".encode()
            self.plain.append(plain)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        with np.errstate(over="ignore"):
            for length, found in by_length.items():
                keys = _hashes(_points([p for p, _, _ in found]))[:, -1]
                order = np.argsort(keys)
                if len(np.unique(keys)) < len(keys):
                    raise ValueError("two pieces have the same hash")
                ids = np.array([i for _, i, _ in found], np.int32)[order]
                self.tables[length] = keys[order], ids, np.array([s for _, _, s in found])[order]
        self.longest = max(self.tables, default=1)
        self.filters: dict[int, np.ndarray] = {}
        for length, (keys, _, _) in self.tables.items():
            self.filters[length] = np.zeros(1 << (64 - int(_FILTER_SHIFT)), bool)
            self.filters[length][keys >> _FILTER_SHIFT] = True
        self.shown = [""] * (len(self.plain) + 1)  # the last one, -1, stands for no piece
        self.lengths = np.ones(len(self.plain) + 1, np.int64)
        for piece, k in self.surface.items():
            self.shown[k], self.lengths[k] = piece, len(piece)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # --- encoding -----------------------------------------------------------

    def _scores(self, prefix: np.ndarray, length: int, power: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Score and piece of the substring of this length at every position: no piece is -1."""
        missing = self.unknown_score if length == 1 else -np.inf
        part = prefix[length:] - prefix[: len(prefix) - length] * power
        score = np.full(part.shape, missing)
        piece = np.full(part.shape, -1, np.int32)
        if length in self.tables:
            keys, ids, values = self.tables[length]
            # Most substrings are no piece: a small table of key prefixes tells, before the search.
            likely = np.flatnonzero(self.filters[length][part >> _FILTER_SHIFT])
            asked = part.reshape(-1)[likely]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            same = keys[at] == asked
            hit, at = likely[same], at[same]
            score.reshape(-1)[hit], piece.reshape(-1)[hit] = values[at], ids[at]
        return score, piece

    def _advance(self, words: Sequence[str]) -> list[array]:
        """Best segmentation of words of one length."""
        points = _points(words)
        rows, length = points.shape
        lengths = [n for n in sorted(self.tables, reverse=True) if n <= length]
        if 1 not in lengths:
            lengths.append(1)
        with np.errstate(over="ignore"):
            prefix = np.ascontiguousarray(_hashes(points).T)
            power = [np.uint64(1)]
            for _ in range(max(lengths)):
                power.append(power[-1] * _BASE)
            scored = {n: self._scores(prefix, n, power[n]) for n in lengths}
        best = np.full((length + 1, rows), -np.inf)
        best[0] = 0.0
        last = np.full((length + 1, rows), -1, np.int32)
        for end in range(1, length + 1):
            for n in lengths:  # from the longest: of equal scores it wins
                if n <= end:
                    score, piece = scored[n]
                    reached = best[end - n] + score[end - n]
                    better = reached > best[end]
                    np.copyto(best[end], reached, where=better)
                    np.copyto(last[end], piece[end - n], where=better)
        # All rows go back together, a piece at a time; pieces are laid down from the right.
        chosen = np.full((rows, length), _NOTHING, np.int32)
        row, end = np.arange(rows), np.full(rows, length)
        for place in range(length - 1, -1, -1):
            piece = last[end, row]
            chosen[row, place] = piece
            end = end - self.lengths[piece]
            row, end = row[end > 0], end[end > 0]
            if not len(row):
                break
        used = chosen != _NOTHING
        ids = array("i", chosen[used].tobytes())
        stops = np.cumsum(used.sum(1)).tolist()
        found = [ids[a:b] for a, b in zip([0, *stops], stops)]
        # A hash stands for the piece only if the characters are the same.
        if "".join(map(self.shown.__getitem__, ids)) != "".join(words):
            found = [self._checked(word, ids) for word, ids in zip(words, found)]
        return found

    def _checked(self, word: str, ids: array) -> array:
        """The pieces of a word, with the bytes of what is no piece."""
        found, at = array("i"), 0
        for k in ids:
            text = word[at : at + int(self.lengths[k])]
            found.extend([k] if k >= 0 and self.shown[k] == text else self._bytes(text))
            at += len(text)
        return found

    def _bytes(self, text: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown_id]
        return [self.byte_ids[b] for b in text.encode()]

    def segment(self, words: Sequence[str]) -> list[array]:
        """Segmentations of any words, those of equal length together.

        Arrays hold numbers, not objects, and go into the store as they are.
        """
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, word in enumerate(words):
            by_length[len(word)].append(k)
        found = [array("i")] * len(words)
        for length, places in by_length.items():
            step = max(1, CELLS // (length * min(length, self.longest)))
            for at in range(0, len(places), step):
                chunk = places[at : at + step]
                for k, ids in zip(chunk, self._advance([words[k] for k in chunk])):
                    found[k] = ids
        return found

    def split(self, text: str) -> list[str]:
        return _WORDS((self.prefix + text).replace(" ", SPACE)) if text else []

    def _cut(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different words of texts, which of them each word is, and the edges of texts."""
        whole = "".join(texts)
        mark = next((c for c in _MARKS if c not in whole), None)

        def marked(text: str) -> str:
            shown = (self.prefix + text).replace(" ", SPACE)
            if SPACE + SPACE in shown:
                return mark.join(_WORDS(shown))
            return shown.replace(SPACE, mark + SPACE).replace("\n", f"{mark}\n{mark}")

        if mark is None:
            cut = pa.array([self.split(t) for t in texts], pa.list_(pa.large_string()))
        else:
            cut = pc.split_pattern(pa.array([marked(t) if t else "" for t in texts], pa.large_string()), mark)
        words = cut.flatten().dictionary_encode()
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        return different, words.indices.to_numpy(), np.asarray(cut.offsets)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Piece ids of texts; every different word is segmented once, and again if long not met."""
        if not len(texts):
            return []
        different, numbers, edges = self._cut(texts)
        wanted = [w for w in different if w]  # marks that meet leave empty ones
        new = [w for w in wanted if w not in self.words]
        if len(self.words) + len(new) > self.remembered // 2:
            self.older, self.words = self.words, {}
            new = wanted
        fresh = []
        for word in new:
            if (ids := self.older.get(word)) is None:
                fresh.append(word)
            else:
                self.words[word] = ids
        for word, ids in zip(fresh, self.segment(fresh)):
            self.words[word] = ids.tobytes()
        return spread([self.words[w] if w else b"" for w in different], numbers, edges)

    # --- decoding -----------------------------------------------------------

    def decode(self, ids: Sequence[int]) -> str:
        numbers = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.plain.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.cache
def pieces_of(path: str, remembered: int = REMEMBERED) -> Pieces:
    return Pieces(path, remembered)


def encode_column(
    path: str, column: str = "text", remembered: int = REMEMBERED // 2, chars: int = RUN_CHARS // 4
) -> Column:
    """Piece ids of a text column, as an array of integers.

    It remembers less than ``round_trip``: in a pipeline its tasks share the memory with earlier stages.
    """

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _coded(pieces_of(path, remembered), batches, chars)

    return encoded(text_of(column))


def decode_column(path: str, column: str = "piece_ids") -> Column:
    """The text of an array of piece ids."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces_of(path)
        for ids in batches:
            yield pd.Series([None if a is None else model.decode(a) for a in ids], dtype=object)

    return decoded(F.col(column))


def _runs(texts: pd.Series, chars: int = RUN_CHARS) -> Iterator[list[str]]:
    """A batch in runs of about ``chars`` characters, so that words held at once stay few."""
    run: list[str] = []
    size = 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def _coded(model: Pieces, batches: Iterator[pd.Series], chars: int) -> Iterator[pd.Series]:
    """The ids of batches. A run goes as soon as it is done: no task holds the ids of a whole batch."""
    for texts in batches:
        for run in _runs(texts, chars):
            yield pd.Series([a.view(np.int32) for a in model.encode(run)], dtype=object)


def round_trip(path: str, column: str = "text") -> Column:
    """Encode, decode again and compare, in one pass: counts, ids as bytes, and the comparison."""
    kind = "n_pieces long, n_byte_pieces long, ids binary, decoded_equal boolean"

    @F.pandas_udf(kind)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = pieces_of(path)
        spelled = np.zeros(len(model.plain), bool)
        spelled[list(model.byte_ids.values())] = True
        for texts in batches:
            for run in _runs(texts):
                ids = model.encode(run)
                yield pd.DataFrame(
                    {
                        "n_pieces": [len(a) for a in ids],
                        "n_byte_pieces": [int(np.count_nonzero(spelled[a])) for a in ids],
                        "ids": [a.tobytes() for a in ids],
                        "decoded_equal": [model.decode(a) == t.replace(SPACE, " ") for a, t in zip(ids, run)],
                    }
                )

    return both(text_of(column))
