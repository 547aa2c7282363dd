"""External induced sorting of short texts, with their common prefixes.

Texts of one width lie in a matrix, a row each. The order of all suffixes that start in one column is induced from the
order of those that start in the next: suffix tuples are taken in the order of their tails and put into the queue of
their first byte, which keeps the order within each byte; the queues are then read byte by byte. A tuple is a row number and
the length of its common prefix with the tuple before; in a queue that is one more than the least common prefix passed
since the last tuple of that byte. Column by column, from the last to the first, the induction calls on its own result.

Queues hold a bounded number of tuples in memory and go to an unnamed scratch file of the task beyond it, and so does
every order, so a shard may be far larger than memory. The scratch file vanishes with the task, however it ends.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: A tuple is one number: the row, and in the lowest byte the common prefix.
TUPLE = np.dtype("<u8")
CHUNK = 1 << 16
HELD = 1 << 22
LOG = np.log2(np.maximum(np.arange(CHUNK + 2), 1)).astype(np.int64)


class Scratch:
    """Appended arrays of tuples, in memory up to a bound, then in a scratch file."""

    def __init__(self, held: int = HELD):
        self.held = held
        self.file = None
        self.parts: list[list] = []
        self.size = 0

    def append(self, part: np.ndarray) -> None:
        self.parts.append([part, 0, len(part)])
        self.size += len(part)
        if self.size > self.held:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for part in self.parts:
            if part[0] is not None:
                part[1] = self.file.tell()
                self.file.write(part[0].tobytes())
                part[0] = None
        self.size = 0

    def read(self, part: list) -> np.ndarray:
        if part[0] is not None:
            return part[0]
        self.file.seek(part[1])
        return np.frombuffer(self.file.read(part[2] * TUPLE.itemsize), TUPLE)

    def __iter__(self) -> Iterator[np.ndarray]:
        for part in self.parts:
            yield self.read(part)


class ByteQueues:
    """A priority queue of tuples by byte, first in, first out for equal bytes."""

    def __init__(self, held: int = HELD):
        self.scratch = Scratch(held)
        self.places: list[list[tuple[int, int, int]]] = [[] for _ in range(256)]

    def push(self, tuples: np.ndarray, bounds: np.ndarray) -> None:
        """Tuples grouped by byte; bounds has where each byte starts, and the end."""
        for byte in np.flatnonzero(np.diff(bounds)):
            self.places[byte].append((len(self.scratch.parts), bounds[byte], bounds[byte + 1]))
        self.scratch.append(tuples)

    def __iter__(self) -> Iterator[np.ndarray]:
        """All tuples, bytes in order, in arrays of about CHUNK tuples."""
        found, size = [], 0
        for places in self.places:
            for part, start, end in places:
                found.append(self.scratch.read(self.scratch.parts[part])[start:end])
                size += end - start
                if size >= CHUNK:
                    yield np.concatenate(found)
                    found, size = [], 0
        if found:
            yield np.concatenate(found)


def rows_of(tuples: np.ndarray) -> np.ndarray:
    return (tuples >> np.uint64(8)).astype(np.int64)


def common_of(tuples: np.ndarray) -> np.ndarray:
    return tuples.astype(np.uint8)


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low..high], both ends included."""
    n = len(values)
    levels = max(1, int(n).bit_length())
    table = np.full((levels, n), 255, np.uint8)
    table[0] = values
    for i in range(1, levels):
        half = 1 << (i - 1)
        size = n - 2 * half + 1
        if size > 0:
            np.minimum(table[i - 1, :size], table[i - 1, half : half + size], out=table[i, :size])
    level = LOG[high - low + 1]
    flat = table.ravel()
    base = level * n
    return np.minimum(flat[base + low], flat[base + high + 1 - (1 << level)])


def induced(order: Scratch, column: np.ndarray, held: int = HELD) -> Scratch:
    """The order of the suffixes that start in a column, from the order of their tails."""
    queues = ByteQueues(held)
    passed = np.zeros(256, np.uint8)  # least common prefix since the last tuple of a byte
    seen = np.zeros(256, bool)
    for whole in order:
        for start in range(0, len(whole), CHUNK):
            tails = whole[start : start + CHUNK]
            common, first = common_of(tails), column[rows_of(tails)]
            at = np.argsort(first, kind="stable")
            bounds = np.concatenate([[0], np.cumsum(np.bincount(first, minlength=256))])
            inner = np.ones(len(tails), bool)
            present = np.flatnonzero(np.diff(bounds))
            heads = bounds[present]
            inner[heads] = False
            shared = np.zeros(len(tails), np.uint8)
            spots = np.flatnonzero(inner)
            if len(spots):
                shared[spots] = _range_minima(common, at[spots - 1] + 1, at[spots]) + 1
            before = np.minimum.accumulate(common)
            shared[heads] = np.where(seen[present], np.minimum(passed[present], before[at[heads]]) + 1, 0)
            queues.push((tails[at] & ~np.uint64(255)) | shared, bounds)
            after = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(255))
            passed = np.minimum(passed, before[-1])
            passed[present] = after[at[bounds[present + 1] - 1] + 1]
            seen[present] = True
    result = Scratch(held)
    for part in queues:
        result.append(part)
    return result


def suffix_orders(columns: np.ndarray, stop: int, held: int = HELD) -> Iterator[tuple[int, Scratch]]:
    """Column and order of its suffixes, from column ``stop`` down to 0; ``columns`` has a row per column of the texts."""
    width, rows = columns.shape
    order = Scratch(held)
    for start in range(0, rows, CHUNK):
        order.append(np.arange(start, min(start + CHUNK, rows), dtype=TUPLE) << np.uint64(8))
    for column in range(width - 1, -1, -1):
        order = induced(order, columns[column], held)
        if column <= stop:
            yield column, order
