"""Words, hashes and windows of text pieces against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from watchfold.llm import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB c\n\té\x0b\x1c.9€😀", max_size=30)), min_size=1, max_size=6)


@settings(deadline=None, max_examples=60)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_agree_with_the_pattern(texts, size):
    found = []
    for piece in words.pieces(pa.array(texts, pa.string()), size):
        data = words.LOWER[piece.data]
        cut = words.split(data, piece.offsets)
        for row in range(piece.last - piece.first):
            span = range(cut.first[row], cut.first[row + 1])
            found.append([bytes(data[cut.start[i] : cut.end[i]]).decode() for i in span])
    fold = {c: c + 32 for c in range(65, 91)}
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)) for t in texts]


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    seen: dict[bytes, int] = {}
    for piece in words.pieces(pa.array(texts, pa.string()), 5):
        cut = words.split(piece.data, piece.offsets)
        for i, value in enumerate(words.hash_words(piece.data, cut).tolist()):
            assert seen.setdefault(bytes(piece.data[cut.start[i] : cut.end[i]]), value) == value
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("counts", [[0], [3], [5], [0, 7, 2, 0, 9], [4, 5, 6]])
def test_windows_of_rows(counts):
    first = np.concatenate([[0], np.cumsum(counts)])
    hashes = np.arange(1, sum(counts) + 1, dtype=np.uint64) % np.uint64(4)
    runs, border = words.windows(hashes, first, 5)
    seen = {}
    for row, n in enumerate(counts):
        row_words = hashes[first[row] : first[row] + n].tolist()
        plain = [tuple(row_words[i : i + 5]) for i in range(max(n - 4, min(n, 1)))]
        assert border[row + 1] - border[row] == len(plain)
        for run, value in zip(plain, runs[border[row] : border[row + 1]].tolist(), strict=True):
            assert seen.setdefault(run, value) == value
    assert len(set(seen.values())) == len(seen)
