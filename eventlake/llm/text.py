"""Vectorised word kernel shared by the text operators.

A batch of texts arrives as one Arrow string column. Its UTF-8 bytes already lie in one buffer, so
words, word hashes, lines and word windows are found for all texts of a batch with numpy passes over
that buffer; no Python string is made per word. Words are maximal runs of bytes other than
``0x20`` and ``0x09-0x0D``, which on valid UTF-8 equals the regular expression
``[^\\x20\\x09-\\x0D]+`` on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEPARATORS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
#: Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_U = np.uint64
_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for positions below n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(max(n, 1 << 20), base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Spans:
    """Hashes of byte ranges of one buffer in constant time each."""

    prefix: np.ndarray
    inverse: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Spans:
        power, inverse = _power_tables(len(data) + 1)
        prefix = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=prefix[1:])
        return cls(prefix, inverse)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix64(raw + (end - start).astype(_U) * _U(0xA0761D6478BD642F))


@dataclass
class Words:
    """The words of a slice of texts: byte ranges, owning text and first word of each text."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts)

    def hashes(self, spans: Spans | None = None) -> np.ndarray:
        return (spans or Spans.of(self.data)).hash(self.start, self.end)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _IS_SEP) -> Words:
    """Words between bytes flagged in ``separators`` (256 flags)."""
    n = len(data)
    inside = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    data, offsets = text_buffer(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, rows)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


#: Bytes other than ASCII letters and digits and those of further characters: what lies between terms.
IS_MARK = np.ones(256, bool)
IS_MARK[0x30:0x3A] = IS_MARK[0x41:0x5B] = IS_MARK[0x61:0x7B] = IS_MARK[0x80:] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_bytes(data: np.ndarray, latin: bool = True) -> np.ndarray:
    """Lower case for ASCII letters and, with ``latin``, for the two-byte capitals of Latin-1."""
    out = _LOWER[data]
    if latin:
        follows = np.flatnonzero(data[:-1] == 0xC3) + 1
        second = data[follows]
        capital = follows[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]
        out[capital] += 0x20
    return out


def split_terms(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of ASCII letters, digits and further characters, with A-Z in lower case."""
    return split_words(lower_bytes(data, latin=False), offsets, IS_MARK)


def window_hashes(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one text, and the index of its first word."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    left = np.repeat(words.first[1:], words.counts) - np.arange(n)
    first = np.flatnonzero(left >= width)
    if not len(first):
        return np.zeros(0, _U), first
    power, inverse = _power_tables(n + 1)
    prefix = np.zeros(n + 1, _U)
    np.cumsum(hashes * power[:n], out=prefix[1:])
    return mix64((prefix[first + width] - prefix[first]) * inverse[first]), first


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
