import random
import re

import numpy as np
import pyarrow as pa

from lumbre.llm.texts import slices, stretch, sums, utf8, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_are_those_of_the_pattern():
    random.seed(5)
    texts = ["".join(random.choices("aB9 .é中🙂_\n", k=random.randint(0, 30))) for _ in range(300)]
    hashes, first = words(*utf8(pa.array(texts)))
    seen = {}
    for k, text in enumerate(texts):
        expected = WORD.findall(lowered(text))
        own = hashes[first[k] : first[k + 1]].tolist()
        assert len(own) == len(expected)
        for word, value in zip(expected, own, strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows_and_long_texts_stand_alone():
    offsets = np.array([0, 5, 5, 30, 31, 40])
    assert list(slices(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(slices(np.array([0]), 10)) == []


def test_stretches_of_equal_bytes_have_equal_hashes():
    running = sums(np.array([7, 9, 7, 9, 8], np.uint64))
    a, b, c = stretch(running, np.array([0, 2, 3]), np.array([2, 4, 5]))
    assert a == b != c


def test_nulls_are_empty_texts():
    offsets, data = utf8(pa.array(["a", None, "bc"]))
    assert offsets.tolist() == [0, 1, 1, 3] and bytes(data[:3]) == b"abc"
