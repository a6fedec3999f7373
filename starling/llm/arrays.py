"""Hashes of words, runs of words and runs of bytes, for a whole step of texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# An odd number near 2**64 / golden ratio: base of the polynomial hashes.
BASE = 0x9E3779B97F4A7C15
# Bytes between words: space, tab and line ends; or these and ASCII punctuation.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = SPACE.copy()
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every run of length values, by doubling; empty if there are fewer."""
    if len(values) < length:
        return np.empty(0, np.uint64)
    out, width, block, size = None, 0, values, 1
    while True:
        factor = np.uint64(pow(BASE, size, 1 << 64))
        if length & size:
            if out is None:
                out, width = block, size
            else:
                many = min(len(out), len(block) - width)
                out, width = out[:many] * factor + block[width : width + many], width + size
        if 2 * size > length:
            return out[: len(values) - length + 1]
        many = len(block) - size
        block, size = block[:many] * factor + block[size : size + many], 2 * size


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every run of length values, by doubling."""
    if len(values) < length:
        return np.empty(0, values.dtype)
    size, block = 1, values
    while 2 * size <= length:
        block, size = np.minimum(block[:-size], block[size:]), 2 * size
    rest = length - size
    return np.minimum(block[: len(values) - length + 1], block[rest : rest + len(values) - length + 1])


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case letters of ASCII and of the Latin-1 part, in UTF-8 bytes. Places stay as they are."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] |= 0x20
    if len(data) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][second] |= 0x20
    return out


@dataclass
class Words:
    """Words (runs of bytes that do not separate words) of several texts, one after the other."""

    data: np.ndarray  # the bytes of all texts, each followed by a line end
    offsets: np.ndarray  # text i begins at offsets[i]
    hashes: np.ndarray  # of each word
    starts: np.ndarray  # its first byte in data
    ends: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i] : bounds[i + 1]

    @property
    def doc(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of length words within one text, and the number of its first word."""
        hashes = rolling(self.hashes, length)
        if not len(hashes):
            return hashes, np.empty(0, np.int64)
        doc = self.doc
        first = np.flatnonzero(doc[: len(hashes)] == doc[length - 1 :])
        return mix(hashes[first]), first


def words_of(texts: list[bytes], between: np.ndarray = SPACE, folded: bool = False) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if folded:
        data = fold(data)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    inside = ~between[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.searchsorted(starts, offsets)
    return Words(data, offsets, hash_spans(data, starts, ends), starts, ends, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; spans follow each other, do not overlap and are not empty."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    powers = np.full(int(sizes.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    values = BYTE[data[place + np.repeat(starts, sizes)]] * powers[place]
    return mix(np.add.reduceat(values, firsts) + sizes.astype(np.uint64))
