"""Vectorised word and shingle hashing over the byte buffers of an Arrow string column.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. All functions work on one block of
documents at a time: ``data`` holds their UTF-8 bytes end to end and ``offsets`` the document limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer document forms a block of its own.
BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SAME = np.arange(256)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + _ODD
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))
_BASE, _INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
_PLACE = _mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n modulo 2 ** 64, kept between blocks."""
    held = _powers.get(base)
    if held is None or len(held) <= n:
        held = np.full(max(n + 1, BLOCK_BYTES + 1), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.multiply.accumulate(held)
    return held


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into blocks of whole documents: (first row, bytes, offsets from 0). A null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte limits of all words, and for each document the index of its first word (one more at the end)."""
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes; ``lower`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[(_LOWER if lower else _SAME)[data]] * _power(_BASE, len(data))[: len(data)], out=sums[1:])
        return _mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order and, for each document, the index of its first one (one more at the
    end). A document of fewer than k words, but at least one, has its whole sequence as one shingle."""
    counts = np.diff(first)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    limits = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(limits[-1], np.uint64)
    with np.errstate(over="ignore"):
        full = counts >= k
        if full.any():
            total = len(hashes) - k + 1
            every = hashes[:total] * _PLACE[0]
            for j in range(1, k):
                every += hashes[j : j + total] * _PLACE[j]
            keep = np.zeros(total + 1, np.int32)
            np.add.at(keep, first[:-1][full], 1)
            np.add.at(keep, first[1:][full] - k + 1, -1)
            place = np.zeros(limits[-1] + 1, np.int32)
            np.add.at(place, limits[:-1][full], 1)
            np.add.at(place, limits[1:][full], -1)
            out[np.cumsum(place[:-1]) > 0] = every[np.cumsum(keep[:-1]) > 0]
        for n in range(1, k):
            docs = np.flatnonzero(counts == n)
            if len(docs):
                whole = np.full(len(docs), n, np.uint64) * _PLACE[k + 1]
                for j in range(n):
                    whole += hashes[first[docs] + j] * _PLACE[j]
                out[limits[docs]] = whole
    return _mix(out), limits


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset (and the end), the number of code points before it."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte limits of all lines (split at newlines) in order, and their documents. Every document has a line at least."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    docs = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, docs))
    starts, docs = starts[order], docs[order]
    last = np.append(docs[1:] != docs[:-1], True)
    return starts, np.where(last, offsets[docs + 1], np.append(starts[1:], 0) - 1), docs
