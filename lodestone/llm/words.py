"""Words of UTF-8 texts as numpy arrays: byte tables tell words from what separates them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are split at a time.
BLOCK = 1 << 20
#: Rows of an Arrow batch that are joined at a time.
ROWS = 4096
_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_BYTE_VALUES = np.random.default_rng(1).integers(0, 1 << 64, 256, np.uint64)
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


class Words(NamedTuple):
    """Words in lower case (A-Z only) with one space after each.

    Where they start and end there and start in the text as it was, the piece each is in, the number of the last piece,
    and how many of the words were there before.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    piece: np.ndarray
    pieces: int
    old: int


class Splitter:
    """``separators`` are the bytes between words, ``breaks`` those of them that also end a piece; all of ASCII."""

    def __init__(self, separators: bytes, breaks: bytes = b""):
        self.word, self.breaks = np.ones(256, bool), np.zeros(256, bool)
        self.word[list(separators)], self.breaks[list(breaks)] = False, True
        self.shown = np.arange(256, dtype=np.uint8)
        self.shown[65:91] += 32
        self.shown[~self.word] = 32
        self.separator = re.compile(b"[" + re.escape(separators) + b"]")

    def split(self, raw: bytes, old: int = 0) -> Words:
        read = np.frombuffer(raw + b" ", np.uint8)
        word = self.word[read]
        before = np.concatenate(([False], word[:-1]))
        first, size = np.flatnonzero(word & ~before), np.flatnonzero(~word & before)
        size -= first
        ends = np.cumsum(size + 1) - 1
        breaks = np.flatnonzero(self.breaks[read])
        return Words(self.shown[read[word | before]], ends - size, ends, first, np.searchsorted(breaks, first), len(breaks), old)

    def blocks(self, raw: bytes, keep: int = 0) -> Iterator[Words]:
        """The words of a joined text in blocks; each begins with up to ``keep`` last words of the one before, if its piece goes on."""
        at, rest, old = 0, b"", 0
        while at < len(raw):
            to = len(raw)
            if to - at > BLOCK:
                cut = self.separator.search(raw, at + BLOCK)
                to = cut.start() if cut else to
            words = self.split(rest + raw[at:to], old)
            yield words
            at, rest, old = to, b"", 0
            if keep and len(words.starts) and words.piece[-1] == words.pieces:
                old = min(keep, int((words.piece[-keep:] == words.pieces).sum()))
                rest = words.data[words.starts[-old] : words.ends[-1]].tobytes()


def joined(values: pa.Array, between: bytes = b"\n") -> bytes:
    """All texts as one, null as the empty text."""
    return between.join([x or b"" for x in values.cast(pa.binary()).to_pylist()])


def groups(columns: list[pa.Array]) -> Iterator[tuple[tuple, pa.Array]]:
    """(values, rows) for each combination of values of the columns, in order of appearance."""
    codes = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        seen = c.dictionary_encode()
        codes = codes * (len(seen.dictionary) + 1) + seen.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if len(order) else ():
        yield tuple(c[int(rows[0])].as_py() for c in columns), pa.array(rows)


def seed(*values: str) -> np.uint64:
    from xxhash import xxh64_intdigest

    return np.uint64(xxh64_intdigest("\0".join(values).encode("utf-8", "surrogatepass"), 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """The numbers with all bits depending on all bits."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            out = np.full(max(n, BLOCK + (BLOCK >> 2)), base & _MASK, np.uint64)
            out[0] = 1
            _POWERS[k] = np.multiply.accumulate(out)
    return _POWERS[0][:n], _POWERS[1][:n]


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, from sums over all bytes so far."""
    up, down = _powers(len(words.data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[words.data] * up)))
    return mixed((total[words.ends] - total[words.starts]) * down[words.starts]) if len(words.starts) else np.zeros(0, np.uint64)


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The slices of the data as strings."""
    size = ends - starts
    offsets = np.concatenate(([0], np.cumsum(size)))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[places]))


def counted(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Different strings and how often each occurs."""
    seen = values.dictionary_encode()
    return seen.dictionary, np.bincount(seen.indices.to_numpy(), minlength=len(seen.dictionary))


def batches_of(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
