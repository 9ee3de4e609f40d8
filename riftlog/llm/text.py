"""Words of whole texts as arrays, a bounded piece of a batch at a time.

A word is a maximal run of letters, digits and bytes beyond ASCII, with A-Z
lower-cased; everything else separates. Words are 64-bit hashes of their UTF-8
bytes, so that n-grams and windows are array operations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PIECE_BYTES = 2_000_000
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x.astype(_U) + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _lower_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            table[b] = b
        elif 65 <= b <= 90:
            table[b] = b + 32
    return table


LOWER = _lower_table()
BYTE_HASH = mix(np.arange(256))
_ODD = 0x9FB21C651E98DF25


class _Powers:
    """Powers of an odd number modulo 2^64, as far as they were ever needed."""

    def __init__(self) -> None:
        self.table = np.ones(1, _U)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            with np.errstate(over="ignore"):
                steps = np.full(max(n, 64), _ODD, _U)
                steps[0] = 1
                self.table = np.cumprod(steps, dtype=_U)
        return self.table


_POWERS = _Powers()


@dataclass
class Words:
    """The words of rows ``first`` .. ``first + rows`` of a batch, in order."""

    first: int
    rows: int
    hash: np.ndarray
    row: np.ndarray  # counted from ``first``
    start: np.ndarray  # byte offsets in the row's text
    end: np.ndarray
    row_start: np.ndarray  # index of each row's first word, and the total
    raw: np.ndarray  # the bytes of these rows
    off: np.ndarray  # where each row's bytes begin, and the total

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams inside rows, and the index of their first words."""
        total = len(self.hash) - n + 1
        if total <= 0:
            return np.empty(0, _U), np.empty(0, np.int64)
        at = np.flatnonzero(self.row[:total] == self.row[n - 1 :])
        with np.errstate(over="ignore"):
            g = np.zeros(total, _U)
            for j in range(n):
                g = g * _U(_ODD) + self.hash[j : j + total]
        return mix(g[at]), at


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(off) else np.empty(0, np.uint8)
    return raw, (off - off[0]) if len(off) else np.zeros(1, np.int64)


def pieces(off: np.ndarray, size: int = PIECE_BYTES, rows: int = 20_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes and ``rows`` rows at most; a longer row
    stands alone, whole."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        b = min(b, n, a + rows)
        yield a, b
        a = b


def words_of(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Words]:
    raw, off = column_bytes(column)
    for a, b in pieces(off, size):
        yield _words(raw[off[a] : off[b]], off[a : b + 1] - off[a], a)


def _words(raw: np.ndarray, off: np.ndarray, first: int) -> Words:
    low = LOWER[raw]
    inside = low != 0
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(raw):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        filled = off[:-1][off[:-1] < off[1:]]  # a word ends with its row
        before[filled] = False
        after[filled[filled > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    if len(start):
        length = end - start
        begin = np.cumsum(length) - length
        powers = _POWERS.upto(int(length.max()))
        place = np.arange(int(length.sum())) - np.repeat(begin, length)
        with np.errstate(over="ignore"):
            h = mix(np.add.reduceat(BYTE_HASH[low[inside]] * powers[place], begin))
    else:
        h = np.empty(0, _U)
    row = np.searchsorted(off, start, "right") - 1
    return Words(first, len(off) - 1, h, row, start - off[row], end - off[row], np.searchsorted(row, np.arange(len(off))), raw, off)


def carried(docs: DataFrame, text_col: str, keep: list[str] | None) -> tuple[DataFrame, Callable]:
    """``docs`` with the columns ``keep`` (all by default) in one column ``row``, so that
    no name of theirs can clash, and how to get the texts of a batch of it. A text that
    is kept anyway is not carried twice."""
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    if text_col in keep and dict(docs.dtypes)[text_col] == "string":
        return docs.select(row), lambda batch: batch.column("row").field(text_col)
    return docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text")), lambda batch: batch.column("text")


def hash_words(text: str) -> np.ndarray:
    """The word hashes of one text."""
    found = list(words_of(pa.array([text], pa.string())))
    return found[0].hash if found else np.empty(0, _U)
