import random
import re

import numpy as np

from arborsync.llm.words import ALPHANUMERIC, NOT_SPACE, shingles, split_words, windows


def test_words_are_those_of_the_patterns():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aZ09 \t\n.é漢-") for _ in range(draw.randint(0, 40))) for _ in range(300)] + [None, ""]
    for table, lower, pattern in (
        (NOT_SPACE, False, rb"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, True, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        raw = [None if t is None else t.encode() for t in texts]
        words = split_words(raw, table, lower=lower)
        expected = [re.findall(pattern, (t or b"").lower() if lower else (t or b"")) for t in raw]
        got = [[words.text(i) for i in range(words.bounds[k], words.bounds[k + 1])] for k in range(len(texts))]
        assert got == expected
        by_word = {}
        for k, own in enumerate(expected):
            for i, word in enumerate(own):
                assert by_word.setdefault(word, words.hashes[words.bounds[k] + i]) == words.hashes[words.bounds[k] + i]
        assert len(set(by_word.values())) == len(by_word)


def test_no_texts_and_long_words():
    assert len(split_words([], NOT_SPACE).hashes) == 0
    a, b = split_words([b"x" * 1000, b"x" * 999 + b"y"], NOT_SPACE).hashes
    assert a != b


def test_windows_and_shingles():
    words = split_words([b"a b c a b c a", b"a b", b""], NOT_SPACE)
    assert len(windows(words.hashes[:7], 3)) == 5
    assert len(shingles(words, 0, 3)) == 3  # abc, bca, cab
    assert len(shingles(words, 1, 3)) == 1
    assert len(shingles(words, 2, 3)) == 0
    assert np.all(np.diff(shingles(words, 0, 3).astype(object)) > 0)
