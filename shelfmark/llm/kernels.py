"""Vectorised text kernels: words, word hashes and k-gram hashes over Arrow batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 equals
``[^\\x20\\x09-\\x0D]+`` over characters.  Hashes are 64-bit: a polynomial over random byte
codes, finished with a bit mixer.  All functions work on one small slice of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd
GRAM = 0xD6E8FEB86659FD93  # odd
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def codes(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(mix(np.arange(1, n + 1, dtype=U) * U(BASE) + U(seed)) + U(seed))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "pow" not in _POWERS or len(_POWERS["pow"]) < n:
        size = max(n, SLICE_BYTES + 1)
        _POWERS["pow"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, BASE, U)]), dtype=U)
        _POWERS["inv"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, pow(BASE, -1, 1 << 64), U)]), dtype=U)
        _POWERS["byte"] = codes(256, 7)
    return _POWERS["pow"], _POWERS["inv"], _POWERS["byte"]


def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """(first row, row count, bytes, offsets) over runs of rows holding about ``most`` bytes.

    A null is an empty text.  A single longer text makes a slice of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offs, offs[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last - first, whole[offs[first]:offs[last]], offs[first:last + 1] - offs[first]
        first = last


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each document (n_docs + 1 entries)."""
    solid = ~_space()[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] |= solid[edges]
    stop[edges - 1] |= solid[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of every word; a part of the buffer at a time, so memory stays bounded."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse, byte = _tables(hi - lo + 1)
        part = data[lo:hi]
        code = byte[_lower()[part]] if lower else byte[part]
        total = np.zeros(hi - lo + 1, U)
        np.cumsum(code * power[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U))
        i = j
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words (len - k + 1 entries), by doubling."""
    if len(hashes) < k:
        return np.zeros(0, U)
    out, width, have, span = None, 0, hashes, 1
    factor = GRAM
    rest = k
    while rest:
        if rest & 1:
            if out is None:
                out, width = have, span
            else:
                n = len(hashes) - width - span + 1
                out = out[:n] * U(factor) + have[width:width + n]
                width += span
        rest >>= 1
        if rest:
            n = len(hashes) - 2 * span + 1
            have = have[:n] * U(factor) + have[span:span + n]
            factor = factor * factor % (1 << 64)
            span *= 2
    return mix(out[:len(hashes) - k + 1] + U(k))


def gram_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each document, sorted, and each set's first entry (n_docs + 1).

    A document of fewer than k words has its whole sequence as its one shingle; one
    without words has the empty set.
    """
    all_grams = grams(hashes, k)
    parts, sizes = [], np.zeros(len(first) - 1, np.int64)
    for d in range(len(first) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= k:
            part = np.sort(all_grams[a:b - k + 1])
            keep = np.ones(len(part), bool)
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            part = part[keep]
        elif b > a:
            part = grams(hashes[a:b], b - a)
        else:
            continue
        parts.append(part)
        sizes[d] = len(part)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate([[0], np.cumsum(sizes)])
