"""Texts in tasks: bounded portions of a column, and words coded as numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import compress, repeat

import numpy as np
import pyarrow as pa

#: Text that a task works on at a time, if no single text is longer.
PORTION_BYTES = 4_000_000

READ_ROWS = 64


def portions(column: pa.Array, size: int = PORTION_BYTES) -> Iterator[list[bytes]]:
    """The values of a binary column in order, nulls as empty, in lists of about `size` bytes."""
    held, total = [], 0
    for first in range(0, len(column), READ_ROWS):
        for cell in column.slice(first, READ_ROWS).to_pylist():
            held.append(cell or b"")
            total += len(held[-1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def give_back() -> None:
    """Memory that this worker's earlier work has left unused goes back to the system, for the other processes of the machine."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def thrifty(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work on a task's batches; a worker that waits for its next task does not hold what it took."""

    def batches(found: Iterator) -> Iterator:
        try:
            yield from work(found)
        finally:
            give_back()

    return batches


class Numbered(dict):
    """A number for every value seen, in order of first appearance."""

    def of(self, values: Sequence) -> tuple[np.ndarray, list]:
        """The numbers of all values, and the values that are new."""
        found = np.fromiter(map(self.get, values, repeat(-1)), np.int64, len(values))
        late = found < 0
        if not late.any():
            return found, []
        missing = list(compress(values, late.tolist()))
        new = list(dict.fromkeys(missing))
        self.update(zip(new, range(len(self), len(self) + len(new))))
        found[late] = np.fromiter(map(self.__getitem__, missing), np.int64, len(missing))
        return found, new


# White space at which bytes are split into words.
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\r\x0b\x0c")] = True

#: Words of so many bytes are compared as two numbers and their length.
SHORT = 16
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

#: A table of words begins with so many slots, as a power of two.
FIRST_SLOTS = 12


def scattered(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of short words."""
    return (low * MULTIPLIERS[0] ^ high * MULTIPLIERS[1]) + size.astype(np.uint64) * MULTIPLIERS[2]


def alike(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that has equal short words side by side, and where in it each word begins."""
    key = scattered(low, high, size)
    by = np.argsort(key)
    if not len(by):
        return by, by
    other = key[by[1:]] != key[by[:-1]]
    differ = (low[by[1:]] != low[by[:-1]]) | (high[by[1:]] != high[by[:-1]]) | (size[by[1:]] != size[by[:-1]])
    if (differ & ~other).any():  # different words of one key
        by = np.lexsort((size, high, low))
        differ = (low[by[1:]] != low[by[:-1]]) | (high[by[1:]] != high[by[:-1]]) | (size[by[1:]] != size[by[:-1]])
    return by, np.flatnonzero(np.append(True, differ))


class Words:
    """Numbers for the words of texts.

    Words of up to `SHORT` bytes are held as two numbers and their length, in arrays that a table of slots points into; a portion's
    words are looked up all at once. Longer ones are keys of a dict.
    """

    def __init__(self) -> None:
        self.count, self.long = 0, {}
        # by number; a long word has size 0
        self.low, self.high, self.size = np.zeros(1, np.uint64), np.zeros(1, np.uint64), np.zeros(1, np.uint8)
        self.slots = np.full(1 << FIRST_SLOTS, -1, np.int32)

    def __len__(self) -> int:
        return self.count

    def __iter__(self) -> Iterator[bytes]:
        """The words by number."""
        long = {number: word for word, number in self.long.items()}
        short = zip(self.low[: self.count].tolist(), self.high[: self.count].tolist(), self.size[: self.count].tolist())
        for number, (low, high, size) in enumerate(short):
            yield (low | high << 64).to_bytes(SHORT, "little")[:size] if size else long[number]

    def in_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The number of words of each text, the numbers of all words, and the words that are new."""
        body = b"\n".join([*texts, bytes(SHORT)])
        space = SPACE[np.frombuffer(body, np.uint8, len(body) - SHORT)]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        begin, size = edge[::2], edge[1::2] - edge[::2]
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        counts = np.diff(np.searchsorted(begin, first))
        eight = np.ndarray(len(body) - 7, "<u8", body, strides=(1,))
        low = eight[begin] & FIRST_BYTES[np.minimum(size, 8)]
        high = eight[np.minimum(begin + 8, len(eight) - 1)] & FIRST_BYTES[np.clip(size - 8, 0, 8)]
        found = self.find(low, high, size)
        late = np.flatnonzero((found < 0) & (size <= SHORT))
        by, group = alike(low[late], high[late], size[late])
        late, once = late[by], late[by[group]]
        found[late] = np.repeat(self.count + np.arange(len(once)), np.diff(np.append(group, len(late))))
        new = [body[a:b] for a, b in zip(begin[once].tolist(), (begin[once] + size[once]).tolist())]
        long, shorter, known = np.flatnonzero(size > SHORT), len(new), self.count
        for place, a, b in zip(long.tolist(), begin[long].tolist(), (begin[long] + size[long]).tolist()):
            word = body[a:b]
            number = self.long.get(word)
            if number is None:
                number = self.long[word] = known + len(new)
                new.append(word)
            found[place] = number
        blank = np.zeros(len(new) - shorter, np.uint64)
        self.add(*(np.concatenate([of[once], blank]) for of in (low, high, size.astype(np.uint64))))
        return counts, found, new

    def add(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> None:
        """Takes in new words, numbered on; those of size 0 are long. The arrays' last place is spare, for number -1."""
        before, self.count = self.count, self.count + len(size)
        self.low, self.high = (np.concatenate([held[:before], more, held[-1:]]) for held, more in ((self.low, low), (self.high, high)))
        self.size = np.concatenate([self.size[:before], size.astype(np.uint8), self.size[-1:]])
        if 2 * self.count > len(self.slots):
            self.slots = np.full(1 << (2 * self.count).bit_length(), -1, np.int32)
            before = 0
        number = before + np.flatnonzero(self.size[before:-1])
        at = self.home(self.low[number], self.high[number], self.size[number])
        while len(number):
            free = self.slots[at] < 0
            self.slots[at[free]] = number[free]
            on = self.slots[at] != number
            number, at = number[on], (at[on] + 1) & (len(self.slots) - 1)

    def home(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot from which a short word is looked for."""
        return (scattered(low, high, size) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of words; -1 if a word is new or long."""
        found = np.full(len(low), -1, np.int64)
        rest = np.flatnonzero(size <= SHORT)
        at = self.home(low, high, size)[rest]
        while len(rest):
            number = self.slots[at]
            taken = number >= 0
            same = taken & (self.low[number] == low[rest]) & (self.high[number] == high[rest]) & (self.size[number] == size[rest])
            found[rest[same]] = number[same]
            on = taken & ~same
            rest, at = rest[on], (at[on] + 1) & (len(self.slots) - 1)
        return found
class Coded(dict):
    """A number for every value asked for; those not seen before get it from `number`."""

    def __init__(self, number: Callable) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, value):
        self[value] = found = self.number(value)
        return found

    def all(self, values: Iterable, count: int, dtype: type) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, values), dtype, count)
