"""Content-chosen anchors of byte windows, for whole Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tallgrove.llm.words import mix, pieces, powers, raw


class Piece(NamedTuple):
    first: int  # row of the batch
    bounds: np.ndarray
    data: bytes
    sums: np.ndarray  # prefix sums of the rolling hash

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def hash(self, start: np.ndarray, length: int) -> np.ndarray:
        """Of the byte strings that begin at the starts."""
        down = powers(len(self.sums))[1]
        return mix((self.sums[start + length] - self.sums[start]) * down[start])


def byte_pieces(texts: pa.Array, size: int = 300_000) -> Iterator[Piece]:
    offsets, everything = raw(texts)
    for at, to in pieces(offsets, size):
        data = everything[offsets[at] : offsets[to]]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][:-1], out=sums[1:])
        yield Piece(at, offsets[at : to + 1] - offsets[at], data.tobytes(), sums)


def sliding(values: np.ndarray, width: int, what: np.ufunc) -> np.ndarray:
    """``what`` (minimum or maximum) of each ``width`` consecutive values, by block prefixes and suffixes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rest = -len(values) % width
    padded = np.append(values, np.full(rest, values[-1], values.dtype)).reshape(-1, width)
    prefix = what.accumulate(padded, 1).ravel()
    suffix = what.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return what(suffix[:n], prefix[width - 1 : width - 1 + n])


def spread(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the [start, end)."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def whole_windows(piece: Piece, length: int) -> np.ndarray:
    """Whether a window of ``length`` bytes inside one text begins at each byte."""
    begin = piece.bounds[:-1]
    end = np.maximum(begin, piece.bounds[1:] - length + 1)
    return spread(begin, end, len(piece.data))


class Anchors:
    """Starts of the strings of ``depth`` bytes whose hash is least in some valid window of ``length`` bytes.

    All that tie for the least are chosen, so a window's own anchors depend on nothing but its bytes. Other
    windows' anchors may lie in it, but where its bytes stand elsewhere these need not be chosen.
    """

    def __init__(self, piece: Piece, length: int, depth: int, valid: np.ndarray) -> None:
        self.width = length - depth + 1
        self.size = len(piece.data)
        self.codes = np.maximum(piece.hash(np.arange(max(0, self.size - depth + 1)), depth), np.uint64(1))
        self.least = sliding(self.codes, self.width, np.minimum)
        shown = np.where(valid[: len(self.least)], self.least, np.uint64(0))
        none = np.zeros(self.width - 1, np.uint64)
        most = sliding(np.concatenate([none, shown, none]), self.width, np.maximum)[: len(self.codes)]
        self.at = np.flatnonzero(most == self.codes) if len(shown) else np.zeros(0, np.int64)

    def windows_of(self, some: np.ndarray) -> np.ndarray:
        """Whether one of the anchors ``some`` is the window's own, for the window at each byte."""
        out = np.zeros(self.size, bool)
        if len(some) and len(self.least):
            picked = np.full(len(self.codes), np.uint64(2**64 - 1))
            picked[some] = self.codes[some]
            out[: len(self.least)] = sliding(picked, self.width, np.minimum) == self.least
        return out
