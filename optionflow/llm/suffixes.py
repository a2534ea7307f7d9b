"""Suffixes of a task's strings: their order, and which neighbours share a long prefix.

The longest common prefixes come from the Burrows-Wheeler transform alone. A breadth-first search starts with
the interval of all rows and extends intervals backward by every symbol that stands before their rows. The
search for prefixes of length `value` finds all borders between rows that share exactly `value` symbols, so
borders are found by increasing value, and the search stops at the length asked for: rows without a
border share at least so much.
"""

from __future__ import annotations

import numpy as np

#: Bits of a sort key.
KEY_BITS = 63

#: Intervals are kept for all rows until only one row in so many is in one.
SPARSE = 8


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each followed by a 0, and where each starts."""
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint16) + 1
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    symbols[ends - 1] = 0
    return symbols, ends - sizes


def sorted_by(keys: np.ndarray, bits: int, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places (their numbers, if not given) in the order of keys of so many bits, and the keys in order."""
    room = int(len(keys) if places is None else places.max(initial=0)).bit_length()
    if bits + room > KEY_BITS:
        by = np.argsort(keys)
        return by if places is None else places[by], keys[by]
    # key and place in one number: sorting numbers is many times faster than sorting places by keys
    both = keys << room
    both |= np.arange(len(keys)) if places is None else places
    both.sort()
    return both & ((1 << room) - 1), both >> room


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of the symbols in the order of their first `depth` ones."""
    n = len(symbols)
    # as many symbols in a key as their number and that of the rotations allow
    used = np.bincount(symbols) > 0
    bits, place = max(1, int(used.sum() - 1).bit_length()), n.bit_length()
    known = min(max(1, (KEY_BITS - place) // bits), depth)
    code = (np.cumsum(used) - 1)[symbols]
    wide = np.concatenate([code, np.resize(code, known)])
    key = wide[:n].copy()
    for j in range(1, known):
        key <<= bits
        key |= wide[j : j + n]
    order, key = sorted_by(key, bits * known)
    rank = np.empty(n, np.int64)
    tied = np.arange(n)  # places of the order whose rotations are not told apart
    while True:
        new = np.append(True, key[1:] != key[:-1])
        # a group's rank is its first place
        rank[order[tied]] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.append(new[1:], True))]
        if known >= depth or not len(tied):
            return order
        step = min(known, depth - known)
        rotation = order[tied]
        after = rotation + step
        after[after >= n] %= n
        key = rank[rotation] << place
        key |= rank[after]
        order[tied], key = sorted_by(key, 2 * place, rotation)
        known += step


def borders(transform: np.ndarray, least: int) -> np.ndarray:
    """For each row of a Burrows-Wheeler transform, whether it shares fewer than `least` symbols with the row before.

    The rows have to be in order by their first `least` symbols.
    """
    n = len(transform)
    before = np.argsort(transform, kind="stable").astype(np.int32)  # the row that each row comes from by a step back
    symbol = transform[before]
    other = np.append(True, symbol[1:] != symbol[:-1])
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    interval, active = np.zeros(n, np.int32), n  # the interval that each row is in, -1 if it is in none
    left = least
    while left and active > n // SPARSE:
        # a row stands in the interval of its symbol and of the interval that the row before it stood in
        came = interval[before]
        new = other.copy()
        new[1:] |= came[1:] != came[:-1]
        first = np.flatnonzero(new)
        ends = np.append(first[1:], n)
        on = came[first] >= 0
        on[on] = ~border[ends[on]]
        border[ends[on]] = True
        size = ends - first
        interval = np.repeat(np.where(on, np.arange(len(first)), -1).astype(np.int32), size)
        active, left = int(size[on].sum()), left - 1
    if not left or not active:
        return border[:n]
    onto = np.empty(n, np.int32)
    onto[before] = np.arange(n, dtype=np.int32)
    rows = np.flatnonzero(interval >= 0)
    interval = interval[rows]
    for _ in range(left):
        reached = onto[rows]
        by = np.argsort(reached)
        reached, came = reached[by], interval[by]
        if not len(reached):
            break
        new = np.append(True, (reached[1:] != reached[:-1] + 1) | (came[1:] != came[:-1]) | other[reached[1:]])
        ends = reached[np.append(new[1:], True)] + 1
        fresh = ~border[ends]
        border[ends] = True
        run = np.cumsum(new) - 1
        on = fresh[run]
        rows, interval = reached[on], run[on]
    return border[:n]


def least_of_equals(texts: list[bytes], values: np.ndarray, least: int) -> list[np.ndarray]:
    """For each text and each place where `least` bytes of it start: the smallest value of all texts that hold these bytes."""
    symbols, starts = joined(texts)
    order = suffix_order(symbols, least)
    border = borders(symbols[order - 1], least)
    sizes = np.diff(np.append(starts, len(symbols))) - least  # places of each text, with the end mark counted
    sizes = np.maximum(sizes, 0)
    most = np.iinfo(np.int64).max
    value = np.full(len(symbols), most, np.int64)
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    value[at] = np.repeat(values, sizes)
    first = np.flatnonzero(border)
    smallest = np.minimum.reduceat(value[order], first)
    value[order] = np.repeat(smallest, np.diff(np.append(first, len(order))))
    return np.split(value[at], np.cumsum(sizes)[:-1])
