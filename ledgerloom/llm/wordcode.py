"""Words of many texts at once: boundaries and 64-bit codes in numpy.

A code mixes the word's size and its bytes, eight at a time; equal words have
equal codes, words of up to eight bytes never share one with another of their
size, and for vocabularies of some millions of words the chance of any clash
is below one in a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from xxhash import xxh64_intdigest

from .common import ASCII_LOWER, ASCII_SPACES

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
#: Masks of the first n of eight bytes.
FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
#: Longer pieces are hashed one at a time.
_LONG = 64

#: True for bytes that belong to a word: everything but ASCII white space, or letters only.
ANY = np.ones(256, bool)
ANY[list(ASCII_SPACES)] = False
LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True


def mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(32))) * _ODD
    return codes ^ (codes >> np.uint64(29))


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A code for each pair of codes, in order."""
    return mixed(first * _BASE + second)


def piece_codes(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Codes of the pieces of `data` that begin at `starts`: their sizes, then eight bytes at a time."""
    padded = data + bytes(8)
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    codes = sizes.astype(np.uint64)
    left, at, size = slice(None), starts, np.minimum(sizes, _LONG)
    for _ in range(_LONG // 8):
        codes[left] = paired(codes[left], eights[at] & FIRST_BYTES[np.minimum(size, 8)])
        more = np.flatnonzero(size > 8)
        if not len(more):
            break
        left = more if isinstance(left, slice) else left[more]
        at, size = at[more] + 8, size[more] - 8
    for i in np.flatnonzero(sizes > _LONG).tolist():
        codes[i] = xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return codes


def word_codes(texts: list[bytes | None], members: np.ndarray = ANY) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words in order, and the number of the text that each is from. A-Z counts as a-z."""
    data = b"\n".join(x or b"" for x in texts).translate(ASCII_LOWER)
    inside = members[np.frombuffer(data, np.uint8)]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter((len(x or b"") + 1 for x in texts), np.int64, len(texts))
    return piece_codes(data, starts, ends - starts), np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0))


def word_code(word: str) -> int:
    return int(word_codes([word.encode()])[0][0])


def chunks(texts: list, size: int = 1 << 20) -> Iterator[tuple[int, list]]:
    """Runs of consecutive texts of about `size` bytes, each with the number of its first; a longer text is a run of its own."""
    first, used = 0, 0
    for at, text in enumerate(texts):
        used += len(text or b"")
        if used >= size:
            yield first, texts[first : at + 1]
            first, used = at + 1, 0
    if first < len(texts):
        yield first, texts[first:]


class CodeIndex:
    """Finds the number of a code among `keys` (all different), or -1: linear probing, many at a time."""

    def __init__(self, keys: np.ndarray):
        self.mask = np.uint64((1 << max(4, int(2 * len(keys) + 1).bit_length())) - 1)
        self.codes = np.zeros(int(self.mask) + 1, np.uint64)
        self.numbers = np.full(int(self.mask) + 1, -1, np.int32)
        left, step = np.arange(len(keys)), np.uint64(0)
        while len(left):
            slot = (keys[left] + step) & self.mask
            free = self.numbers[slot] < 0
            self.numbers[slot[free]] = left[free]  # of several the last stays
            placed = self.numbers[slot] == left
            self.codes[slot[placed]] = keys[left[placed]]
            left, step = left[~placed], step + np.uint64(1)
        self.steps = int(step)

    def find(self, codes: np.ndarray) -> np.ndarray:
        slot = codes & self.mask
        found = self.numbers[slot]
        found[(self.codes[slot] != codes)] = -1
        left = np.flatnonzero((found < 0) & (self.numbers[slot] >= 0))
        for step in range(1, self.steps):
            if not len(left):
                break
            slot = (codes[left] + np.uint64(step)) & self.mask
            number = self.numbers[slot]
            hit = (number >= 0) & (self.codes[slot] == codes[left])
            found[left[hit]] = number[hit]
            left = left[~hit & (number >= 0)]
        return found
