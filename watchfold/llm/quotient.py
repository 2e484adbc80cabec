"""Counting quotient filters whose remainders are whole: lossless compact counters.

A key of one or more 64-bit words goes through an invertible permutation. The leading bits
of what comes out are the shard, the next ones the quotient and all others the remainder,
so that the filter of a shard holds its keys' remainders in order, one per key, beside
two bits per slot that say which quotient each belongs to, and undoing the permutation
gives the keys back. Counters take one byte, larger ones their own place.

Filters of one shard are in the same order whoever wrote them and merge as sorted runs.
"""

from __future__ import annotations

import struct

import numpy as np

# Multipliers of the permutation and their inverses modulo 2**64.
_FIRST, _SECOND = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_FIRST_BACK, _SECOND_BACK = pow(_FIRST, -1, 1 << 64), pow(_SECOND, -1, 1 << 64)

_HEAD = struct.Struct("<IBBBB")
_ESCAPE = 255


def _unshift(x: np.ndarray, by: int) -> np.ndarray:
    """Undoes ``x ^ (x >> by)``."""
    out = x
    for _ in range(64 // by):
        out = x ^ (out >> np.uint64(by))
    return out


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_FIRST)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_SECOND)
    return x ^ (x >> np.uint64(31))


def unscramble(x: np.ndarray) -> np.ndarray:
    x = _unshift(x, 31) * np.uint64(_SECOND_BACK)
    x = _unshift(x, 27) * np.uint64(_FIRST_BACK)
    return _unshift(x, 30)


def permute(keys: np.ndarray) -> np.ndarray:
    """A bijection of rows of 64-bit words; every word counts for the first one."""
    out = keys.copy()
    width = out.shape[1]
    for i in range(width):
        out[:, i] = scramble(out[:, i] ^ out[:, i - 1] if width > 1 else out[:, i])
    if width > 1:
        out[:, 0] ^= out[:, -1]
        out[:, 0] = scramble(out[:, 0])
    return out


def unpermute(keys: np.ndarray) -> np.ndarray:
    out = keys.copy()
    width = out.shape[1]
    if width > 1:
        out[:, 0] = unscramble(out[:, 0])
        out[:, 0] ^= out[:, -1]
    for i in reversed(range(width)):
        out[:, i] = unscramble(out[:, i])
        if width > 1:
            out[:, i] ^= out[:, i - 1]
    return out


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order with the sums of their counts. Sorted runs merge quickly."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort(keys.T[::-1])
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    return keys[first], np.add.reduceat(counts[order], first)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order and how often each is there."""
    if keys.shape[1] > 1:
        return counted(keys, np.ones(len(keys), np.int64))
    ordered = np.sort(keys[:, 0])
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
    return ordered[first][:, None], np.diff(first, append=len(ordered))


def pack(keys: np.ndarray, counts: np.ndarray, shard_bits: int) -> bytes:
    """The filter of distinct permuted keys of one shard, in order."""
    n, width = keys.shape
    # remainders of whole bytes, with a number of quotients near that of the keys
    rest_bytes = min(8, -(-(64 - shard_bits - max(n - 1, 1).bit_length()) // 8))
    rest_bytes = max(rest_bytes, 8 - (shard_bits + 24) // 8, 1)
    quotient_bits = max(64 - shard_bits - 8 * rest_bytes, 0)
    low = 64 - shard_bits - quotient_bits
    inner = keys[:, 0] & np.uint64((1 << (64 - shard_bits)) - 1)
    quotient = (inner >> np.uint64(low)).astype(np.int64) if quotient_bits else np.zeros(n, np.int64)
    slots = np.zeros(n + (1 << quotient_bits), np.uint8)
    slots[quotient + np.arange(n)] = 1  # a one per key, a zero where the next quotient begins
    rest = np.ascontiguousarray(keys[:, 0]).view(np.uint8).reshape(n, 8)[:, : -(-low // 8)].copy()
    if low % 8:
        rest[:, -1] &= (1 << (low % 8)) - 1
    small = np.where(counts < _ESCAPE, counts, _ESCAPE).astype(np.uint8)
    large = counts[counts >= _ESCAPE].astype(np.int64)
    head = _HEAD.pack(n, width, shard_bits, quotient_bits, 0)
    others = np.ascontiguousarray(keys[:, 1:])
    return b"".join([head, np.packbits(slots).tobytes(), rest.tobytes(), others.tobytes(), small.tobytes(), large.tobytes()])


def unpack(data: bytes, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """The permuted keys of a filter, in order, and their counts."""
    n, width, shard_bits, quotient_bits, _ = _HEAD.unpack_from(data)
    low = 64 - shard_bits - quotient_bits
    raw, at = np.frombuffer(data, np.uint8), _HEAD.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at]

    slots = n + (1 << quotient_bits)
    ones = np.flatnonzero(np.unpackbits(take(-(-slots // 8)), count=slots))
    quotient = (ones - np.arange(n)).astype(np.uint64)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, : -(-low // 8)] = take(n * -(-low // 8)).reshape(n, -1)
    keys = np.empty((n, width), np.uint64)
    high = (np.uint64(shard) << np.uint64(64 - shard_bits)) if shard_bits else np.uint64(0)
    keys[:, 0] = rest.view(np.uint64)[:, 0] | (quotient << np.uint64(low) if low < 64 else np.uint64(0)) | high
    keys[:, 1:] = take(n * 8 * (width - 1)).view(np.uint64).reshape(n, width - 1)
    counts = take(n).astype(np.int64)
    large = np.flatnonzero(counts == _ESCAPE)
    counts[large] = take(8 * len(large)).view(np.int64)
    return keys, counts


def shards_of(keys: np.ndarray, shard_bits: int) -> np.ndarray:
    """The shard of each permuted key."""
    return (keys[:, 0] >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(keys), np.int64)


def filters(keys: np.ndarray, counts: np.ndarray, shard_bits: int) -> list[tuple[int, bytes]]:
    """Filters of distinct permuted keys in order, one for each shard that has any."""
    shard = shards_of(keys, shard_bits)
    borders = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, int)
    return [
        (int(shard[low]), pack(keys[low:high], counts[low:high], shard_bits))
        for low, high in zip(borders[:-1], borders[1:], strict=True)
    ]


def merge(parts: list[bytes], shard: int) -> tuple[np.ndarray, np.ndarray]:
    """All permuted keys of filters of one shard with their total counts."""
    found = [unpack(x, shard) for x in parts]
    return counted(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
