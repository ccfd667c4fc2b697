"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A batch's bytes are handled in pieces of about ``PIECE`` bytes that end with a
document, so the working memory depends on the longest document, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 300_000
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words split at ASCII white space: all but space and 0x09-0x0D.
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

#: Bytes of words made of digits, ASCII letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


class Words(NamedTuple):
    first: int  # row of the batch with which the piece begins
    bounds: np.ndarray  # rows + 1 offsets into data
    data: np.ndarray  # lower-cased bytes of the piece
    start: np.ndarray  # of each word in data
    end: np.ndarray
    doc: np.ndarray  # row of each word, counted from first
    hash: np.ndarray  # uint64

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.rows)


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    global _powers
    if len(_powers[0]) < n:
        grown = []
        for factor in (BASE, INVERSE):
            row = np.full(n, factor, np.uint64)
            row[0] = 1
            grown.append(np.cumprod(row, dtype=np.uint64))
        _powers = tuple(grown)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null rows are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not wide and not (pa.types.is_string(texts.type) or pa.types.is_binary(texts.type)):
        texts = texts.cast(pa.string())
    _, where, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one longer row."""
    rows, at = len(offsets) - 1, 0
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), rows)
        yield at, to
        at = to


def words(texts: pa.Array, kept: np.ndarray = SPACED, size: int = PIECE) -> Iterator[Words]:
    offsets, everything = raw(texts)
    for at, to in pieces(offsets, size):
        bounds = offsets[at : to + 1] - offsets[at]
        data = LOWER[everything[offsets[at] : offsets[to]]]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = kept[data]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # A word never runs across the border of two documents.
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]) if len(cuts) else cuts
        if len(cuts):
            start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
        doc = np.searchsorted(bounds, start, "right") - 1
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        code = (sums[end] - sums[start]) * down[start]
        yield Words(at, bounds, data, start, end, doc, mix(code + (end - start).astype(np.uint64)))


def grams(w: Words, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words of one document, and the index of their first word."""
    if len(w.hash) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.full(len(w.hash) - n + 1, seed, np.uint64)
    for i in range(n):
        code *= np.uint64(BASE)
        code += w.hash[i : len(w.hash) - n + 1 + i]
    index = np.flatnonzero(w.doc[: len(w.doc) - n + 1] == w.doc[n - 1 :])
    return mix(code[index]), index
