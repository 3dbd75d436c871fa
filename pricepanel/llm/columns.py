"""Column-wise work on the text buffers of Arrow batches.

A slice of rows is seen as one byte array, so words, word hashes and hashes of
any run of words come from a few numpy passes over all rows at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 1 << 20
#: Bytes whose word hashes are computed at once, so that a very long text needs no more memory than its words.
HASH_BYTES = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_SALT = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true for the bytes of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything but space and U+0009 to U+000D.
VISIBLE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Digits, lower-case a-z and every byte of a character beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


#: What frees the objects that a worker keeps for its next task, by the name of their owner.
_KEPT: dict[str, Callable[[], None]] = {}


def kept(owner: str, free: Callable[[], None]) -> None:
    """A worker keeps something large from now on; ``free`` is called when it turns to a task of another owner."""
    _KEPT[owner] = free


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, owner: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that a slice holds at most ``limit`` bytes of text.

    Workers outlive their tasks: what tasks other than those of ``owner`` have kept is freed first.
    """
    others = [name for name in _KEPT if name != owner]
    for name in others:
        _KEPT.pop(name)()
    if others:
        _give_back()
    try:
        for batch in batches:
            _, offsets = raw(batch.column(column))
            row = 0
            while row < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
                end = min(max(end, row + 1), batch.num_rows)
                yield batch.slice(row, end - row)
                row = end
    finally:
        _give_back()


def _give_back() -> None:
    """Return freed memory to the machine: a worker waits for its next task with as little as it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def raw(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, index, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if index is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(index, kind, len(texts) + 1, texts.offset * size).astype(np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    content = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    return (_LOWER[content] if lower else content), offsets - lo


def _inverse(x: np.uint64) -> np.uint64:
    """Inverse of an odd number modulo 2**64."""
    y = int(x)
    for _ in range(6):
        y = y * (2 - int(x) * y) % 2**64
    return np.uint64(y)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i in 0..n."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) <= n:
        size = max(n + 1, 1 << 12)
        both = []
        for b in (base, _inverse(base)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        known = _POWERS[int(base)] = (both[0], both[1])
    return known[0][: n + 1], known[1][: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Runs:
    """Hashes of any runs ``[start, end)`` of a sequence of 64-bit values in constant time each."""

    def __init__(self, values: np.ndarray, base: np.uint64 = _Q):
        powers, self._back = _powers(base, len(values))
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[: len(values)], out=self._sums[1:])
        self._forward = powers

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64))

    def without(self, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of the run with its element ``at`` left out; equals ``of`` of the shorter run."""
        head = (self._sums[at] - self._sums[start]) * self._back[start]
        tail = (self._sums[end] - self._sums[at + 1]) * self._back[start + 1]
        return mix(head + tail + (end - start - 1).astype(np.uint64))


class Words:
    """Words of a slice of rows: ``start`` and ``end`` byte, ``hash``, and ``first[r]:first[r+1]`` by row."""

    def __init__(self, texts: pa.Array, inside: np.ndarray, lower: bool = False):
        self.bytes, self.offsets = raw(texts, lower)
        n = len(self.bytes)
        mask = inside[self.bytes]
        before = np.zeros(n, bool)
        before[1:] = mask[:-1]
        before[self.offsets[:-1][self.offsets[:-1] < n]] = False
        self.start = np.flatnonzero(mask & ~before)
        after = np.zeros(n, bool)
        after[:-1] = mask[1:]
        last = self.offsets[1:] - 1
        after[last[last >= 0]] = False
        self.end = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        cuts = np.searchsorted(self.start, np.arange(0, len(self.bytes) + HASH_BYTES, HASH_BYTES))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if a < b:
                base = self.start[a]
                runs = Runs(_SALT[self.bytes[base : self.end[b - 1]]], _P)
                out[a:b] = runs.of(self.start[a:b] - base, self.end[a:b] - base)
        return out

    def word(self, i: int) -> bytes:
        return self.bytes[self.start[i] : self.end[i]].tobytes()
