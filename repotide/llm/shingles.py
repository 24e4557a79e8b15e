"""Sets of word shingles of a text as sorted 64-bit hashes, without a regular expression."""

import numpy as np

SIZE = 5
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; longer texts are cut between words.
CHUNK = 1 << 20


def mixed(x):
    """A finalizer that spreads every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_tables():
    """(is a word byte, number of each byte after lower-casing) for the word rule of `common`."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = (low >= 0x80) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
    return word, mixed(low.astype(np.uint64) + np.uint64(1)) | np.uint64(1)


class Hasher:
    """Word and shingle hashes; keeps the powers it needs."""

    def __init__(self):
        self.word, self.number = byte_tables()
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n):
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            # cumprod wraps modulo 2**64, as the hash does
            self.up = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(size, _INVERSE, np.uint64)))

    def words(self, text):
        """One hash for each word of a text."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        out, at = [], 0
        while at < len(data):
            stop = min(len(data), at + CHUNK)
            while stop < len(data) and self.word[data[stop]]:
                stop += 1
            part = data[at:stop]
            inside = self.word[part]
            edge = np.diff(inside.view(np.int8), prepend=0, append=0)
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            self._powers(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.number[part] * self.up[: len(part)], out=sums[1:])
            out.append(mixed((sums[ends] - sums[starts]) * self.down[starts]))
            at = stop
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def shingles(self, text, size=SIZE):
        """Distinct shingle hashes in order. A text of fewer words, but not none, is one shingle."""
        words = self.words(text) if text else np.zeros(0, np.uint64)
        n = len(words)
        if not n:
            return words
        size = min(size, n)
        total = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            total = mixed(total + words[k : n - size + 1 + k] + np.uint64(k + 1))
        return np.unique(total)
