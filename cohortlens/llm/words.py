"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a maximal run of characters other than space and U+0009 to U+000D;
those are single bytes in UTF-8, so words are found on the bytes. A byte range is
hashed eight bytes at a time, each mixed into the hash of those before it, and by
BLAKE2b where it is long. Runs of words are polynomials over 2**64 of such hashes,
read from prefix sums; they are meant for runs of at most some hundred words
(beyond a thousand, two words in a suitable order cancel out in any base).
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

from .batches import text_offsets

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of a range that are mixed eight at a time; longer ranges are digested.
_MIXED = 64
_WORD_BASE = 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept and grown by doubling."""
    if base not in _powers:
        _powers[base] = (np.ones(1, np.uint64), np.ones(1, np.uint64))
    up, down = _powers[base]
    inverse = pow(base, -1, 1 << 64)
    while len(up) < n:
        k = len(up)
        up = np.concatenate([up, up * np.uint64(pow(base, k, 1 << 64))])
        down = np.concatenate([down, down * np.uint64(pow(inverse, k, 1 << 64))])
        _powers[base] = (up, down)
    return up, down


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each pair, the same wherever the range lies."""
    _, down = powers(base, len(sums))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place (zeros after the end), as one number."""
    return np.ndarray((len(raw) + 1,), "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))


def byte_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of raw[start:end] for each pair, the same wherever the bytes lie."""
    eight = eight_bytes(raw)
    size = end - start
    h = mix64(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    left = np.flatnonzero(size <= _MIXED)
    for done in range(0, _MIXED, 8):
        left = left[size[left] > done]
        if not len(left):
            break
        some = np.minimum(size[left] - done, 8).astype(np.uint64)
        value = eight[start[left] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * some))
        h[left] = mix64(h[left] ^ value) + np.uint64(0xC2B2AE3D27D4EB4F)
    for k in np.flatnonzero(size > _MIXED).tolist():
        h[k] = int.from_bytes(blake2b(raw[start[k] : end[k]], digest_size=8).digest(), "little")
    return h


@dataclass
class Texts:
    """Words of a column of texts, one text after the other."""

    raw: np.ndarray  # all bytes
    at: np.ndarray  # first byte of each text, and the end
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    count: np.ndarray  # words of each text
    first: np.ndarray  # first word of each text, and the number of words
    hash: np.ndarray  # of each word

    @property
    def text(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after it, and the first word of each text (and their number)."""
    inside = ~SEPARATOR[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = at[:-1][at[:-1] < len(raw)]
    opens[edges] = inside[edges]
    before = at[1:][at[1:] > 0] - 1
    closes[before] = inside[before]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(start, at)


def read_texts(column: pa.Array, lower_ascii: bool = False) -> Texts:
    raw, at = text_offsets(column)
    if lower_ascii:
        raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    start, end, first = word_bounds(raw, at)
    return Texts(raw, at, start, end, np.diff(first), first, byte_hash(raw, start, end))


def windows(t: Texts, size: int) -> np.ndarray:
    """First word of every run of ``size`` words inside one text."""
    if len(t.start) < size:
        return np.zeros(0, np.int64)
    at = np.arange(len(t.start) - size + 1)
    left = np.repeat(t.first[1:], t.count)[: len(at)] - at  # words from here to the text's end
    return at[left >= size]


def run_hash(t: Texts, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each word of ``at``."""
    base = (_WORD_BASE + 2 * seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1) | 1
    values = t.hash if not seed else mix64(t.hash + np.uint64(seed))
    return range_hash(prefix_sums(values, base), at, at + size, base)
