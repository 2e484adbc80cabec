"""Counting quotient filters lose nothing."""

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from watchfold.llm import quotient


@pytest.mark.parametrize("width", [1, 3])
@pytest.mark.parametrize("bits", [0, 1, 7, 13])
@pytest.mark.parametrize("n", [0, 1, 2, 255, 5000])
def test_keys_and_counts_come_back(width, bits, n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 64, (n, width), dtype=np.uint64)
    keys[: n // 2] >>= np.uint64(40)
    counts = rng.choice([1, 2, 254, 255, 256, 10**12], n).astype(np.int64)
    ordered, sums = quotient.counted(quotient.permute(np.concatenate([keys, keys])), np.concatenate([counts, counts]))
    made = quotient.filters(ordered, sums, bits)
    back = [quotient.unpack(data, shard) for shard, data in made]
    twice = [quotient.merge([data, data], shard) for shard, data in made]
    if n:
        assert (np.concatenate([k for k, _ in back]) == ordered).all()
        assert (np.concatenate([c for _, c in back]) == sums).all()
        assert (np.concatenate([c for _, c in twice]) == 2 * sums).all()
        assert set(map(tuple, quotient.unpermute(ordered).tolist())) == set(map(tuple, keys.tolist()))
    else:
        assert made == []


@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=50), st.integers(1, 3))
def test_the_permutation_is_invertible(values, width):
    keys = np.array(values * width, np.uint64).reshape(-1, width)
    assert (quotient.unpermute(quotient.permute(keys)) == keys).all()


def test_distinct_small_keys_take_few_bytes():
    keys, counts = quotient.counted(quotient.permute(np.arange(1 << 16, dtype=np.uint64)[:, None]), np.ones(1 << 16, np.int64))
    size = sum(len(data) for _, data in quotient.filters(keys, counts, 3))
    assert size < 8 * (1 << 16)  # a plain key and a counter take nine
