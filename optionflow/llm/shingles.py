"""Word shingles of texts as sets of 64-bit hashes.

Sets are told apart by a 64-bit fingerprint, so among d different sets about d^2 / 2^65
pairs are mistaken for equal: none up to a few billion.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .texts import Words

# The multipliers of the splitmix64 finalizer and its increment.
MIX_A, MIX_B, GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15

#: Words whose hashes a task remembers.
REMEMBERED = 500_000


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A seeded bijection of 64-bit numbers that scatters them evenly."""
    x = x + np.uint64((seed + 1) * GOLDEN % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """The distinct n-word shingles of texts. A-Z counts as a-z, words end at ASCII white space."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.words, self.hashes = Words(), np.empty(0, np.uint64)

    def rolled(self, texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Each text's number of words, all words' hashes, and a hash of every n words in a row, of neighbouring texts too."""
        if len(self.words) > REMEMBERED:
            self.words, self.hashes = Words(), np.empty(0, np.uint64)
        n = self.n
        counts, word, new = self.words.in_texts([t.lower() for t in texts])
        if new:
            fresh = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.hashes = np.concatenate([self.hashes, fresh])
        word = self.hashes[word] if len(word) else np.empty(0, np.uint64)
        places = max(0, len(word) - n + 1)
        rolled = np.zeros(places, np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(GOLDEN) + word[k : k + places]
        return counts.tolist(), word, mix(rolled, n)

    def repeated(self, texts: list[bytes]) -> np.ndarray:
        """The shingles of all texts of n words and more, with repeats, in no order that matters."""
        counts, _, rolled = self.rolled(texts)
        inside = np.ones(len(rolled), bool)
        over = np.cumsum(counts)[:, None] - 1 - np.arange(self.n - 1)
        inside[over[(over >= 0) & (over < len(rolled))]] = False
        return rolled[inside]

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        """A sorted array per text.

        A text of fewer than n words has its whole word sequence as its one shingle, a text without words has
        none.
        """
        n = self.n
        counts, word, rolled = self.rolled(texts)
        found, first = [], 0
        for count in counts:
            if count >= n:
                found.append(np.unique(rolled[first : first + count - n + 1]))
            elif count:
                whole = 0
                for w in word[first : first + count].tolist():
                    whole = (whole * GOLDEN + w) % 2**64
                found.append(mix(np.array([whole], np.uint64), 1000 - count))
            else:
                found.append(np.empty(0, np.uint64))
            first += count
        return found


def fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit number per set."""
    total = np.add.reduce(mix(shingles, 77)) + np.uint64(len(shingles))
    return int(mix(np.array([total], np.uint64), 78).view(np.int64)[0])
