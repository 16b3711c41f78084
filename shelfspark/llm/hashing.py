"""Vectorised hashes of words and word shingles over a column of texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_M_INVERSE = np.uint64(pow(int(_M), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: White space between words: U+0020 and U+0009 to U+000D.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, put together from two short tables (nothing of length ``n`` is kept)."""
    low, high = _tables(int(base))
    if n <= len(low):
        return low[:n]
    rows = -(-n // len(low))
    if rows > len(high):
        high = np.full(rows, high[1], np.uint64)
        high[0] = 1
        high = np.multiply.accumulate(high)
    return np.multiply.outer(high[:rows], low).ravel()[:n]


@lru_cache(maxsize=16)
def _tables(base: int, size: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """base**0 .. base**(size-1), and the same for base**size."""
    out = []
    for b in (base, pow(base, size, 1 << 64)):
        table = np.full(size, np.uint64(b))
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out[0], out[1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets of the texts; nulls are empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 word offsets of the texts; ``outside`` marks the bytes between words."""
    inside = ~outside[raw]
    starts = inside.copy()
    ends = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # A text's border parts words too.
    inner = offsets[1:-1]
    inner = inner[inner < len(raw)]
    starts[inner] |= inside[inner]
    border = offsets[1:-1]
    border = border[border > 0] - 1
    ends[border] |= inside[border]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words in lower case (A-Z)."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers(_M, len(raw)), out=total[1:])
    value = (total[ends] - total[starts]) * powers(_M_INVERSE, len(raw) + 1)[starts]
    return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles, in order, and their n + 1 offsets.

    A text of fewer than ``n`` words has its whole sequence as the one shingle, an empty text none.
    """
    counts = np.diff(offsets)
    sizes = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    salt = powers(np.uint64(0xD6E8FEB86659FD93), n + 1)[1:]
    text_of = np.repeat(np.arange(len(counts)), sizes)
    first = offsets[text_of] + (np.arange(len(text_of)) - out_offsets[text_of])
    length = np.minimum(counts, n)[text_of]
    out = length.astype(np.uint64)
    top = len(hashes) - 1
    for k in range(n):
        part = hashes[np.minimum(first + k, top)] * salt[k] if top >= 0 else out * 0
        out = out + np.where(k < length, part, np.uint64(0))
        out = mix(out)
    return out, out_offsets
