"""Hashed word shingles of whole texts, computed over Arrow buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts hashed in one go hold about this many bytes together; a longer text is hashed alone.
SLICE_BYTES = 256_000
# Multipliers of the hashes (odd, otherwise arbitrary).
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a common generator; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, computed as far as asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 2**64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
                for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = Powers(_BASE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets between them; null is empty."""
    a = column.cast(pa.large_string()).cast(pa.large_binary())
    if a.null_count:
        a = a.fill_null(b"")
    buffers = a.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def runs_of_texts(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together, one text at least."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    Words are runs of anything but space and the control characters 9 to 13, with A-Z
    lower-cased. A text of fewer words has all of them as one shingle, a text without words none.
    """
    for first, last in runs_of_texts(offsets):
        start, end = int(offsets[first]), int(offsets[last])
        yield from _sets(data[start:end], offsets[first:last + 1] - start, width)


def word_spans(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word of the texts, and the number of words before each text (and before the end)."""
    n = len(b)
    solid = ~((b == 32) | ((b >= 9) & (b <= 13)))
    joined = np.zeros(n + 1, bool)  # whether the byte before belongs to the same word
    joined[1:n] = solid[1:] & solid[:-1]
    joined[offsets] = False
    begins = np.flatnonzero(solid & ~joined[:n])
    ends = np.flatnonzero(solid & ~joined[1:]) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def span_hashes(b: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    n = len(b)
    up, down = _POWERS.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64) * _BASE)


def _sets(b: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    begins, ends, bounds = word_spans(b, offsets)
    words = span_hashes(np.where((b >= 65) & (b <= 90), b + np.uint8(32), b), begins, ends)
    m = len(words)
    whole = np.zeros(max(m - width + 1, 0), np.uint64)
    for j in range(width):
        whole += words[j:j + len(whole)] * _PLACES[j % 5] * np.uint64(2 * (j // 5) + 1)
    whole = mix(whole)
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if z - a >= width:
            yield np.unique(whole[a:z - width + 1])
        elif z > a:
            part = sum((int(w) * (2 * k + 3) for k, w in enumerate(words[a:z])), z - a) % 2**64
            yield mix(np.array([part], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
