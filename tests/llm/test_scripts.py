"""Languages of many scripts, whose letters are more than any small alphabet has."""

from __future__ import annotations

import numpy as np

from shelfmark.llm import language_id

# First letter and number of letters of a script; two languages share the ideographs but not the ones they use.
SCRIPTS = {
    "en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "ar": (0x627, 20), "hi": (0x905, 40), "ko": (0xAC00, 2000),
    "ja": (0x3041, 80), "zh": (0x4E00, 2000), "yue": (0x4E00 + 2000, 2000), "ka": (0x10D0, 33),
}


def texts(lang, number, chars, random):
    first, size = SCRIPTS[lang]
    for _ in range(number):
        letters = first + random.integers(0, size, chars)
        letters[5::7] = 0x20
        yield "".join(map(chr, letters))


def test_long_texts_of_many_scripts():
    """Chance letters of a script: only which letters occur tells the language."""
    random = np.random.default_rng(7)
    rows = [(t, lang) for lang in SCRIPTS for t in texts(lang, 12, 6000, random)]
    model = language_id.LanguageModel.fit(*map(list, zip(*rows)))
    for chars in (60, 20_000):
        held = [(t, lang) for lang in SCRIPTS for t in texts(lang, 4, chars, random)]
        names, scores = model.predict([t for t, _ in held])
        assert names == [lang for _, lang in held]
        assert scores.min() > 0


def test_ngrams_are_exact():
    """Letters 16 code points apart, which shared a class, and n-grams of different lengths are all different."""
    letters = language_id.letter_table()
    sets = [set(language_id.grams_of(t, letters).tolist()) for t in ("一", "丐", "丠", "a")]
    assert all(len(s) == 4 for s in sets) and len(set.union(*sets)) == 16
    assert language_id.grams_of("Ab", letters).tolist() == language_id.grams_of(" aB", letters).tolist()
    # a, b; _a, ab, b_; _ab, ab_
    assert len(language_id.grams_of("ab", letters)) == 7
    assert language_id.grams_of("12 !", letters) is None
