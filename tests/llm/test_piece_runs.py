"""What the segmentation of a run of texts asks of Python, and that marks, blanks and hash hits change nothing."""

from wearline.llm import pieces
from wearline.llm.queries import vocabulary_file


class Counting(dict):
    asked = 0

    def __getitem__(self, word):
        self.asked += 1
        return super().__getitem__(word)


def test_words_are_asked_for_once_a_run():
    own = pieces.Pieces(vocabulary_file("piece_bpe_32k.model"))
    own.words = Counting()
    found = own.encode(["one two " * 500, "two one " * 500])
    assert own.words.asked < 10 and [len(f) for f in found] == [len(found[0])] * 2


def test_odd_texts_equal_their_words():
    own = pieces.Pieces(vocabulary_file("piece_bpe_32k.model"))
    texts = ["", " ", "\n", "a  b", "  x\n\n y ", "▁x▁▁y", "日本語 🎉x", "\0a b\1\nc ", "İ\ttab", "a\n", "".join(map(chr, range(9))) + " ab"]
    for run in [texts, *([t] for t in texts)]:
        for text, found in zip(run, own.encode(run), strict=True):
            assert found.tolist() == [k for word in own.split(text) for k in own.segment([word])[0]]


def test_signs_for_all_marks(monkeypatch):
    own = pieces.Pieces(vocabulary_file("piece_bpe_32k.model"))
    plain = own.encode(["a b\nc", "\0  d"])
    monkeypatch.setattr(pieces, "_MARKS", ["\0"])
    assert [a.tolist() for a in own.encode(["a b\nc", "\0  d"])] == [a.tolist() for a in plain]


def test_a_hash_that_is_no_piece_is_spelled():
    """A piece whose characters differ from those of its hash is not taken."""
    own = pieces.Pieces(vocabulary_file("piece_bpe_32k.model"))
    word = "▁the"
    *before, last = own.segment([word])[0]
    spelled = own._bytes(own.shown[last])
    own.shown[last] = "????"
    assert list(own.segment([word, "▁was"])[0]) == [*before, *spelled]


def test_ids_leave_in_runs():
    """The ids of a run are out before the texts after it are coded."""
    own = pieces.Pieces(vocabulary_file("piece_bpe_32k.model"))
    encode, coded = own.encode, []
    own.encode = lambda texts: coded.extend(texts) or encode(texts)
    runs = pieces._coded(own, iter([[f"text {k} of many" for k in range(100)]]), chars=50)
    assert len(next(runs)) < 10 and len(coded) < 10
    assert sum(map(len, runs)) > 80 and len(coded) == 100
