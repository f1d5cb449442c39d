"""Vectorised text hashing for Python tasks: polynomial prefix hashes over byte buffers.

``sums[i]`` is the hash of the first ``i`` bytes modulo 2**64, so any span's hash takes two
look-ups and one multiplication, whatever its length. Bytes go through a table of random
64-bit values first, and the multiplier is 3 modulo 8, which keeps the low bits useful.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWERED_VALUES = BYTE_VALUES.copy()               # A-Z hash as a-z
LOWERED_VALUES[65:91] = BYTE_VALUES[97:123]
MULTIPLIER = 0x9E3779B97F4A7C13                   # 3 modulo 8
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict = {}


def powers(n: int, base: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """``len(data) + 1`` prefix hashes of a ``uint8`` buffer."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(len(data), MULTIPLIER), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each span ``[start, stop)``, the same wherever its bytes stand."""
    return (sums[stop] - sums[start]) * powers(len(sums), INVERSE)[start]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the white-space separated words; none crosses a document edge."""
    letter = ~IS_SPACE[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] = letter[inner]
    last[inner - 1] = letter[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


# ASCII letters, and ASCII punctuation that always ends a run of letters; apostrophes, < | >
# and white space are neither
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = True


def word_parts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words``, cut once more between letters (ASCII and Latin-1) and punctuation marks."""
    start, stop = words(data, edges)
    begins, closes = _LETTER[data], _LETTER[data]
    if len(data) > 1:
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (
            data[1:] != 0x97) & (data[1:] != 0xB7)
        begins[:-1] |= latin
        closes[1:] |= latin
    mark = _MARK[data]
    cut = np.flatnonzero((closes[:-1] & mark[1:]) | (mark[:-1] & begins[1:])) + 1
    if len(cut):
        cut = cut[~np.isin(cut, edges, assume_unique=False)]
    return np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([stop, cut]))


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``n + 1`` offsets of an Arrow string column; null texts are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def groups_of(offsets: np.ndarray, limit: int):
    """Slices ``(i, j)`` of whole documents with at most ``limit`` bytes, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def binary_column(flat: np.ndarray, offsets: np.ndarray):
    """An Arrow binary column over one contiguous buffer (``offsets`` in elements)."""
    import pyarrow as pa

    data = np.ascontiguousarray(flat)
    offs = (offsets * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())])
