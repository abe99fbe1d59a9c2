"""64-bit hashes of all tokens of a byte string, without a Python step per token.

A token is a run of bytes of one class. With ``H`` the running sum of
``mixed(byte i) * BASE**i`` modulo 2**64, a token from ``s`` to ``e`` hashes to
``(H[e] - H[s]) * BASE**-s``: its place drops out, equal tokens are equal.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1
WINDOW = 1 << 20


def _byte_values() -> np.ndarray:
    value = np.arange(1, 257, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for _ in range(3):
            value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            value ^= value >> np.uint64(27)
    return value


_VALUES = _byte_values()


@functools.cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        powers = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            while len(powers) < count:
                step = np.uint64(pow(base, len(powers), 2**64) & _MASK)
                powers = np.concatenate([powers, powers * step])
        found.append(powers[:count])
    return found[0], found[1]


def _window(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(10, int(len(data) + 1).bit_length())
    powers, inverse = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * powers[: len(data)], dtype=np.uint64)])
        hashes = (sums[ends] - sums[starts]) * inverse[starts]
        # Short tokens differ in few bits of the sum only; spread them over all bits.
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0x94D049BB133111EB)
        hashes ^= hashes >> np.uint64(29)
    return hashes, starts


def token_hashes(data: bytes, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every token; ``members`` says for each byte value if it is inside one."""
    array = np.frombuffer(data, np.uint8)
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(array):
        end = min(len(array), at + WINDOW)
        inside = members[array[at:end]]
        while end < len(array) and inside[-1] and members[array[end]]:
            # The window ends inside a token: cut before it, or go on to its end.
            outside = np.flatnonzero(~inside)
            if len(outside):
                end, inside = at + int(outside[-1]) + 1, inside[: int(outside[-1]) + 1]
            else:
                end = min(len(array), end + WINDOW)
                inside = members[array[at:end]]
        found, first = _window(array[at:end], inside)
        hashes.append(found)
        starts.append(first + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def byte_class(chosen: bytes) -> np.ndarray:
    members = np.zeros(256, bool)
    members[np.frombuffer(chosen, np.uint8)] = True
    return members
