"""Words of many texts at once, as byte ranges and 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

# Words of `[^\x20\x09-\x0D]+`, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in lower-cased text. Both
# classes hold every byte of a character beyond ASCII, so that UTF-8 can be cut byte by byte.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S1, _S2 = np.uint64(29), np.uint64(32)
_LONG = 1024


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = h * _M1
    h ^= h >> _S1
    h *= _M2
    h ^= h >> _S2
    return h


def bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of the words, and how many words come before each text (one more than texts)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    is_in = inside[data]
    first = is_in.copy()
    first[1:] &= ~is_in[:-1]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[cuts] = is_in[cuts]
    last = is_in
    last_byte = last.copy()
    last_byte[:-1] &= ~is_in[1:]
    last_byte[cuts - 1] = is_in[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last_byte) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, by its content alone."""
    out = mix((ends - starts).astype(np.uint64) + np.uint64(1))
    if len(starts) == 0:
        return out
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    length = ends - starts
    long = np.flatnonzero(length > _LONG)
    for i in long:
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    at, left, who = starts, length, None
    if len(long):
        who = np.flatnonzero(length <= _LONG)
        at, left = starts[who], length[who]
    while len(at):
        word = eight[at] & _MASK[np.minimum(left, 8)]
        if who is None:
            out = mix(out ^ word)
        else:
            out[who] = mix(out[who] ^ word)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        who = more if who is None else who[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of `size` words in a row of one text, ascending.

    A shorter text that has words is one shingle.
    """
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    h = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        h = mix(h ^ words[k : n - width + 1 + k])
    return np.unique(h)
