"""Words of whole texts as numpy arrays: positions, 64-bit hashes and window hashes of many documents at once.

A word is a maximal run of bytes other than space and the five control characters 9 to 13. Hashes are
polynomials modulo 2**64 taken from prefix sums, so the cost per byte does not depend on word or window
length; equal words always get equal hashes.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Also takes ASCII punctuation for white space.
PLAIN = LOWER.copy()
PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1
#: Bytes hashed at a time; bounds the temporary arrays, whatever the length of a text.
PIECE_BYTES = 1 << 17


def kept_by_process(name: str) -> dict:
    """A dictionary that a worker process keeps between tasks.

    The library travels to tasks by value, so that its own globals start anew in each of them.
    """
    return vars(sys).setdefault("_legmeter_kept", {}).setdefault(name, {})


class Shared:
    """A broadcast of any value, also of the library's own classes, which workers need not be able to import."""

    def __init__(self, spark: SparkSession, value) -> None:
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self._sent.value)


def _powers(base: int, size: int) -> np.ndarray:
    powers = kept_by_process("powers")
    known = powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        powers[base] = known = np.cumprod(known, dtype=np.uint64)
    return known[:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _span_hashes(symbols: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``symbols[start:end]`` for each pair, by prefix sums."""
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * _powers(base, len(symbols)), dtype=np.uint64, out=sums[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(symbols) + 1)
    return mix((sums[end] - sums[start]) * inverse[start])


@dataclass
class Words:
    """Words of a run of documents. ``bounds[d]:bounds[d + 1]`` are those of document ``d``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def documents(self) -> int:
        return len(self.bounds) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.documents), np.diff(self.bounds))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words inside one document, and the index of their first word."""
        first = np.arange(max(0, len(self.hash) - size + 1))
        if len(first):
            row = self.row_of_word()
            first = first[row[first] == row[first + size - 1]]
        if not len(first):
            return np.empty(0, dtype=np.uint64), first
        return _span_hashes(self.hash, _WORD_BASE, first, first + size), first

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        limit = max(int(np.searchsorted(end, start[at] + PIECE_BYTES, "right")), at + 1)
        low, high = int(start[at]), int(end[limit - 1])
        symbols = data[low:high].astype(np.uint64) + np.uint64(1)
        hashes[at:limit] = _span_hashes(symbols, _BYTE_BASE, start[at:limit] - low, end[at:limit] - low)
        at = limit
    return hashes


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None) -> Words:
    """Words of the documents ``data[offsets[d]:offsets[d + 1]]``, each byte replaced by its entry in ``table``."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if table is not None:
        data = table[data]
    solid = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(SPACE[data], out=solid[1:-1])
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    bounds = np.searchsorted(start, offsets)
    return Words(data, start, end, _word_hashes(data, start, end), bounds)


def arrow_texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without a copy; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    return data, offsets


def document_runs(
    column: pa.Array, most_bytes: int = 4 << 20, table: np.ndarray | None = None
) -> Iterator[tuple[int, Words]]:
    """``(first row, words)`` of runs of documents of about ``most_bytes``; a longer text is a run of its own."""
    if not len(column):
        return
    data, offsets = arrow_texts(column)
    row = 0
    while row < len(column):
        stop = max(int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1, row + 1)
        stop = min(stop, len(column))
        yield row, words_of(data, offsets[row : stop + 1], table)
        row = stop
