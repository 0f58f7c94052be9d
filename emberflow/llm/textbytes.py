"""Vectorised work on the UTF-8 bytes of a batch of texts (numpy, inside Arrow tasks).

A batch is one byte array with the offsets of its texts. Words, their 64-bit
hashes and k-byte rolling hashes come from one pass of array operations, so no
Python code runs for each word. Hashes are polynomial over bytes, modulo 2**64,
with random byte values and a final mix; they are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words end at these bytes: space, \t, \n, \v, \f, \r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes worked on together; arrays of this length stay in a core's cache.
CHUNK_BYTES = 1 << 17

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE_LOWER = _BYTE[_FOLD]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the largest n asked so far."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 20:
            _powers[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (murmur finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = max(i + 1, min(j, n))
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the word offsets of the texts, and the words' start bytes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    inside = np.zeros(n + 2, bool)
    np.take(_IS_WORD, data, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a word ends where its text ends
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    values = np.take(_BYTE_LOWER if lower else _BYTE, data)
    values *= powers(_BASE, n)
    np.cumsum(values, out=total[1:])
    h = (total[ends] - total[starts]) * powers(_BASE_INV, n)[starts]
    return mix(h), np.searchsorted(starts, offsets, side="left"), starts


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and the shingle offsets of the texts.

    A text of fewer than k words has its whole sequence as its only shingle; a
    text without words has none.
    """
    first, sizes, out = shingle_places(offsets, k)
    if out[-1] == 0:
        return np.zeros(0, np.uint64), out
    full = np.zeros(len(words), np.uint64)
    if len(words) >= k:  # every k neighbours, also across texts; only those of one text are taken
        h = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            h *= _BASE
            h += words[j:len(words) - k + 1 + j]
        full[:len(h)] = h
    found = full[first]
    short = np.flatnonzero((np.diff(offsets) < k) & (sizes > 0))
    if len(short):
        h = np.full(len(short), k, np.uint64)
        padded = np.concatenate([words, np.zeros(k, np.uint64)])
        for j in range(k):
            h *= _BASE
            h += np.where(offsets[short] + j < offsets[short + 1], padded[offsets[short] + j], np.uint64(0))
        found[out[short]] = h
    return mix(found), out


def shingle_places(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every shingle, the shingles of every text, and the texts' shingle offsets."""
    counts = np.diff(offsets)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return np.repeat(offsets[:-1] - out[:-1], sizes) + np.arange(out[-1]), sizes, out


def rolling_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of data[i:i+k] for every i with that much left."""
    n = len(data)
    if n < k:
        return np.zeros(0, np.uint64)
    total = prefix_hashes(data)
    return mix((total[k:] - total[:-k]) * powers(_BASE_INV, n)[:n - k + 1])


def byte_values(data: np.ndarray) -> np.ndarray:
    """The random value of every byte."""
    return _BYTE[data]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums over units (byte values or word hashes) from which ``span_hashes`` takes any string's hash."""
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    return total


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` takes any substring's hash."""
    return prefix_sums(byte_values(data))


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the length mixed in."""
    inv = powers(_BASE_INV, len(total))
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
