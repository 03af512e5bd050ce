from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from tradewake.llm import flat

TEXTS = ["", "One two\tONE  two", None, " ", "é É été-1 x2_y", "a" * 600_000 + " b", "a" * 600_000, "b",
         "one two"]


@pytest.fixture
def found():
    data, offsets = flat.text_buffers(pa.array(TEXTS))
    return data, offsets, flat.words(data, offsets, flat.NOT_SPACE)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_are_those_of_the_pattern(found):
    data, _, (_, starts, ends, counts) = found
    spelled = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert spelled == [w for t in TEXTS for w in re.findall("[^\x20\x09-\x0d]+", t or "")]
    assert counts.tolist() == [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for t in TEXTS]


def test_equal_words_have_equal_hashes_and_others_not(found):
    _, _, (hashes, *_) = found
    spelled = [w for t in TEXTS for w in re.findall("[^\x20\x09-\x0d]+", lowered(t))]
    by_word = {}
    for word, value in zip(spelled, hashes.tolist(), strict=True):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_words_do_not_depend_on_slices_or_offsets():
    column = pa.array(TEXTS).slice(1)
    data, offsets = flat.text_buffers(column)
    assert len(offsets) == len(column) + 1
    whole = flat.words(data, offsets, flat.ALPHANUMERIC)[0]
    parts = [flat.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], flat.ALPHANUMERIC)[0]
             for i, j in flat.row_ranges(offsets, 20)]
    assert np.array_equal(whole, np.concatenate(parts))


def test_shingles_stay_within_rows():
    data, offsets = flat.text_buffers(pa.array(["a b c", "b c", "", "c", "a b c d"]))
    hashes, _, _, counts = flat.words(data, offsets, flat.NOT_SPACE)
    values, positions, own = flat.shingles(hashes, counts, 3)
    assert own.tolist() == [1, 1, 0, 1, 2]
    assert values[0] == values[3] and len(set(values.tolist())) == 4
    assert positions.tolist() == [0, 3, 5, 6, 7]
    assert flat.shingles(hashes, counts, 3, whole=False)[2].tolist() == [1, 0, 0, 0, 2]
