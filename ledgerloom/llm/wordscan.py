"""Words, hashes and windows of Arrow text batches, all at once with numpy.

A batch is cut into blocks of whole texts of about ``BLOCK_BYTES`` bytes; a longer text
is a block of its own. Only the size of a block bounds the memory a task needs.

Hashes are polynomials modulo 2**64 over random byte values, taken from prefix sums
(Rabin and Karp), then mixed. They are the same on every machine.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_U = np.uint64
_GROW = 1 << 16


def _odd(seed: int) -> int:
    return int(np.random.default_rng(seed).integers(1, 1 << 63)) * 2 + 1 & (1 << 64) - 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self, seed: int):
        self.base = _odd(seed)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n + _GROW
            self.up = np.cumprod(np.r_[_U(1), np.full(size - 1, self.base, _U)], dtype=_U)
            self.down = np.cumprod(np.r_[_U(1), np.full(size - 1, self.inverse, _U)], dtype=_U)
        return self.up[:n], self.down[:n]


BYTE_VALUES = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=_U)
_BYTES, _WINDOWS = _Powers(12), {1: _Powers(13), 2: _Powers(14)}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits, one to one."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def class_table(separators: str) -> np.ndarray:
    """True for the byte values of ``separators`` (ASCII)."""
    table = np.zeros(256, bool)
    table[np.frombuffer(separators.encode("ascii"), np.uint8)] = True
    return table


def ascii_lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


WHITE = class_table(" \t\n\x0b\x0c\r")
LOWER = ascii_lower_table()


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` (excluded), their bytes end to end, and each text's start.

    A null counts as an empty text. The starts have one entry more than there are texts.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer or b"", np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, starts: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (excluded) of the runs of true places, cut at every text's start.

    ``breaks``: places at which a new run begins besides.
    """
    begin = np.zeros(len(inside) + 1, bool)
    begin[starts] = True
    if breaks is not None:
        begin[:-1] |= breaks
    begin[1:-1] |= ~inside[:-1]
    begin[:-1] &= inside
    begin[-1] = False
    begins = np.flatnonzero(begin)
    gap = np.ones(len(inside) + 1, bool)
    gap[:-1] = ~inside
    gap[starts] = True
    if breaks is not None:
        gap[:-1] |= breaks
    places = np.flatnonzero(gap)
    return begins, places[np.searchsorted(places, begins, "right")]


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each begin to its end."""
    up, down = _BYTES(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(_U))


def code_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points from each begin to its end."""
    up, down = _BYTES(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(mix(codes.astype(_U) + _U(1)) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(_U))


def window_hashes(words: np.ndarray, size: int, which: int = 1) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive word hashes; ``which`` of two bases."""
    n = len(words)
    if n < size:
        return np.zeros(0, _U)
    up, down = _WINDOWS[which](n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(words * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[: n - size + 1]) * down[: n - size + 1])


def words(data: np.ndarray, starts: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of all words, and the number of words before each text."""
    begins, ends = runs(~separator[data], starts)
    return begins, ends, np.searchsorted(begins, starts)


def packed(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """An Arrow column of the bytes from each begin to its end."""
    sizes = ends - begins
    held = np.ascontiguousarray(data[ragged(begins, sizes)])
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of all pieces ``starts[i] .. starts[i] + counts[i]``, end to end."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)


def lists_of(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """An Arrow column of lists of the given lengths."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """``lists_of`` numpy values."""
    return lists_of(pa.array(values), counts)


def grouped(keys: np.ndarray, owners: np.ndarray, values: np.ndarray, n_keys: int):
    """Values ordered by key and owner.

    Returns the owners of each key end to end, how many values each of them has there, the
    values, and for each key the number of owners and of values.
    """
    return grouped_from([values, owners, keys], n_keys)


def grouped_from(columns: list[np.ndarray], n_keys: int):
    """``grouped`` of a list of values, owners and keys, which it empties to let them go one by one."""
    order = np.lexsort(columns[1:])
    for i in range(3):
        columns[i] = columns[i][order]
    del order
    keys, owners, values = (columns.pop() for _ in range(3))
    new = np.flatnonzero(np.r_[True, (owners[1:] != owners[:-1]) | (keys[1:] != keys[:-1])]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[new, len(keys)]).astype(np.int32)
    return owners[new], counts, values, np.bincount(keys[new], minlength=n_keys), np.bincount(keys, minlength=n_keys)


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(task):
    """A task that gives back what it has freed, as Spark goes on to use its Python process."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


class PieceCache:
    """Ids of byte pieces by their hash, as flat arrays; forgets all when it is full."""

    def __init__(self, most: int = 2_000_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, _U)
        self.places = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the cache, -1 if absent."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        places = len(self.ids) + np.cumsum(counts) - counts
        every = np.r_[self.keys, keys]
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.places = np.r_[self.places, places][order]
        self.counts = np.r_[self.counts, counts][order]
        self.ids = np.r_[self.ids, ids.astype(np.uint32)]

    def encode(self, keys: np.ndarray, encoder) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and the number of ids of each piece.

        ``keys``: a hash of each piece. ``encoder`` gets the places of those pieces that the
        cache doesn't hold, each once, and returns their counts and flat ids.
        """
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        missing = np.flatnonzero(self.find(keys) < 0)
        if len(missing):
            counts, ids = encoder(first[missing])
            if len(self.keys) + len(missing) > self.most:  # what this block needs stays
                known = self.find(keys)
                keep = known[known >= 0]
                kept = (self.keys[keep], self.counts[keep], self.ids[ragged(self.places[keep], self.counts[keep])])
                self.clear()
                self.add(*kept)
            self.add(keys[missing], np.asarray(counts, np.int64), np.asarray(ids))
        at = self.find(keys)[back]
        return self.ids[ragged(self.places[at], self.counts[at])], self.counts[at]
