"""Whole texts as flat byte arrays, hashed without a loop over characters.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lowered; both rules hold byte by
byte in UTF-8. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer text is taken alone.
SLICE_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_OF_BYTE = _RANDOM.integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n + n // 4 + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all of their places."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class Texts(NamedTuple):
    """Rows ``first`` and on of a batch: text ``i`` is ``data[at[i]:at[i + 1]]``."""

    first: int
    at: np.ndarray
    data: np.ndarray


class Words(NamedTuple):
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column, some megabytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.binary()) if not pa.types.is_large_string(column.type) else column.cast(pa.large_binary())
    column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Texts(first, at[first : last + 1] - at[first], data[at[first] : at[last]])
        first = last


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``H`` such that the hash of ``data[s:e]`` is ``(H[e] - H[s]) * inverse[s]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def spans(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``, mixed with the length."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(texts: Texts, lower: bool = True) -> Words:
    """The words of the texts in order, each with the row of its text."""
    data = _LOWER[texts.data] if lower else texts.data
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.at] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (edge[:-1] | ~before))
    end = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    row = np.searchsorted(texts.at, start, "right") - 1
    return Words(spans(prefix_hashes(data), start, end), start, end, row)


def word_counts(texts: Texts) -> np.ndarray:
    """The number of words of each text."""
    inside = ~_SPACE[texts.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[texts.at] = True
    first = inside.copy()
    first[1:] &= edge[1:-1] | ~inside[:-1]
    return np.diff(np.searchsorted(np.flatnonzero(first), texts.at))


def shingles(found: Words, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of runs of ``width`` words; a text of fewer words is one run."""
    count = np.bincount(found.text, minlength=n_texts)
    n = len(found.hash)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = np.uint64(0xC2B2AE3D27D4EB4F)
    size = np.minimum(count, width)[found.text]
    first = np.cumsum(count) - count
    place = np.arange(n) - first[found.text]
    whole = place + size <= count[found.text]
    head = np.flatnonzero(whole)
    out = np.zeros(len(head), np.uint64)
    for k in range(width):
        more = size[head] > k
        step = np.where(more, found.hash[np.minimum(head + k, n - 1)], np.uint64(0))
        out = np.where(more, mix(out * factor + step + np.uint64(k + 1)), out)
    return out, found.text[head]
