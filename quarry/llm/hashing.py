"""Vectorised polynomial hashes of byte ranges."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
#: a random odd number for every byte value
BYTE = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: word bytes: ASCII letters and digits, and every byte of other characters
WORD = np.zeros(256, dtype=bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.append(self.up, self.up * np.uint64(pow(_BASE, size, 1 << 64)))
            self.down = np.append(self.down, self.down * np.uint64(pow(_BASE, -size, 1 << 64)))
        return self.up[:n], self.down[:n]


def scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray, powers: Powers) -> np.ndarray:
    """p with scramble((p[b] - p[a]) * up[a]) a hash of data[a:b]."""
    _, down = powers.upto(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE[data] * down[:len(data)], out=prefix[1:])
    return prefix


def word_hashes(texts: list[str | None], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the lower-cased words of all texts, end to end, and
    the number of words of each text."""
    parts = [t.lower().encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    word = WORD[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.append(0, edge)
    start, stop = edge[0::2], edge[1::2]
    prefix = prefix_hashes(data, powers)
    up, _ = powers.upto(len(data))
    got = (scramble((prefix[stop] - prefix[start]) * up[start]) >> np.uint64(32)).astype("<u4")
    ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(start, np.append(0, ends)))
    return got, counts
