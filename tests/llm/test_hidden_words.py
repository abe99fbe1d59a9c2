"""Toxic words written wholly in signs, or split by separators."""

from wearline.llm import deobfuscate


def test_signs_alone_and_split_words():
    clean = ["the class passed a grass path and has as many as the mass of glass asks", "plain words of an idle editor more or less"]
    model = deobfuscate.letter_model(deobfuscate.trigram_counts(clean * 20 + ["ass idiot moron"] * 20))
    reader = deobfuscate.Reader(model, {"ass$": 3.0, **{f: 3.0 for w in ("idiot", "moron") for f in deobfuscate.features(w)}})
    for text in ("@$$", "455", "an @55!", "idi-ot", "mor.on", "4 5 5"):
        assert reader.total(text) == 3.0, text
        assert reader.words(text) & {"ass", "idiot", "moron"}, text
    for text in ("in 2024, 1000 of 3.50 $20", "--- !!! ...", "12:30 99%"):
        assert reader.total(text) == 0.0 and not any(len(w) > 2 for w in reader.words("1000")), text
