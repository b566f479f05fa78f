"""Words and hashed word sequences of texts, as numpy arrays over Arrow batches.

A word is a run of bytes other than blank and U+0009 to U+000D; the letters A-Z count as
a-z. Words are 64-bit hashes here. All arrays of a chunk are made by a few passes over
its bytes, without a Python loop over words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package installed: the functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are held as 64-bit arrays at a time. A longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18
SEED = 20240229

_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(SEED).integers(1, 1 << 64, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    return values


def _is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all their bits can be used."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, np.uint64(base), dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Words:
    """Words of one chunk of texts.

    ``hashes`` holds one hash per word, ``first`` the index of the first word of every
    text and, at its end, the number of words. ``starts`` and ``ends`` are byte offsets.
    """

    def __init__(self, hashes, first, starts, ends):
        self.hashes, self.first, self.starts, self.ends = hashes, first, starts, ends

    def some(self, places: np.ndarray) -> Words:
        """The words at ``places``, in order."""
        first = np.searchsorted(places, self.first)
        return Words(self.hashes[places], first, self.starts[places], self.ends[places])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Tokenizer:
    """Splits chunks of bytes into hashed words; keeps its tables between chunks."""

    def __init__(self):
        self.values, self.space = _byte_values(), _is_space()
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """``offsets``: byte offsets of the texts in ``data``, one more than texts."""
        size = len(data)
        if not size:
            none = np.zeros(0, dtype=np.int64)
            return Words(none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none)
        if len(self.powers) < size + 1:
            self.powers = _powers(_BASE, size + 1)
            self.inverse = _powers(_INVERSE, size + 1)
        word = ~self.space[data]
        cuts = offsets[(offsets > 0) & (offsets < size)]
        joined = np.empty(size + 1, dtype=bool)  # whether byte i continues byte i - 1
        joined[0] = joined[size] = False
        np.logical_and(word[1:], word[:-1], out=joined[1:size])
        joined[cuts] = False
        starts = np.flatnonzero(word & ~joined[:-1])
        ends = np.flatnonzero(word & ~joined[1:]) + 1
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[:size], dtype=np.uint64, out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts])
        return Words(hashes, np.searchsorted(starts, offsets), starts, ends)


def text_chunks(
    texts: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``from`` and ``to``, bytes and byte offsets of runs of texts.

    A null counts as an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    buffers = texts.buffers()
    count = len(texts)
    if not count:
        return
    offsets = np.frombuffer(buffers[1], dtype=kind)[
        texts.offset : texts.offset + count + 1
    ].astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    row = 0
    while row < count:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), count)
        own = offsets[row : stop + 1]
        yield row, stop, data[own[0] : own[-1]], own - own[0]
        row = stop


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each text's begin.

    A text with fewer words has the run of all its words, one without words none.
    """
    counts = np.diff(words.first)
    total = len(words.hashes)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(first[-1], dtype=np.uint64)
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(first[-1]) - first[text] + words.first[text]
    length = np.minimum(counts, size)[text]
    for k in range(size):
        inside = k < length
        value = words.hashes[np.minimum(at + k, max(total - 1, 0))] if total else out
        out = np.where(inside, (out + value) * np.uint64(_BASE + 2 * k), out)
    return mix(out + length.astype(np.uint64)), first
