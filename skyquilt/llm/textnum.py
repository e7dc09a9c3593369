"""Words and word shingles of many texts as numpy arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look independent."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(_BASE) + _U(seed)) | _U(1)


_BYTE = constants(256, 11)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Words:
    """The words of many texts in one buffer: start and end of each (bytes), its hash, and where each text begins."""

    def __init__(self, texts: Sequence[str | None]) -> None:
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b" ".join(data) + b" "
        buf = np.frombuffer(self.raw, np.uint8)
        self.low = _LOWER[buf]
        edge = np.flatnonzero(np.diff(_SPACE[buf], prepend=True))  # starts and ends of words in turn
        self.starts, self.ends = edge[::2], edge[1::2]
        self.begin = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
        self.first = np.searchsorted(self.starts, self.begin)  # of the words; the last entry is their number

    def hashes(self) -> np.ndarray:
        """Of each word, with A-Z in lower case."""
        n = len(self.low)
        power, inverse = _powers(1 << max(20, n.bit_length()))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.low] * power[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64))


def chunks(texts: Sequence[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters each, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: Sequence[str | None], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of k words; of the whole sequence if it has fewer, none without words."""
    factor = constants(k, 29)
    for a, b in chunks(texts):
        own = Words(texts[a:b])
        words, first = own.hashes(), own.first
        runs = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for j in range(k):
            runs += words[j : j + len(runs)] * factor[j]
        runs = mix(runs)
        for i in range(b - a):
            n = first[i + 1] - first[i]
            if n >= k:
                yield np.unique(runs[first[i] : first[i + 1] - k + 1])
            elif n:
                yield mix(np.array([(words[first[i] : first[i + 1]] * factor[:n]).sum(dtype=np.uint64) + _U(n)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def sketch(values: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """For each factor, the least of the products with the values: minwise tokens of 32 bits."""
    low = np.full(len(factor), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(values), 2048):
        part = ((values[i : i + 2048, None] * factor) >> _U(32)).astype(np.uint32)
        np.minimum(low, part.min(axis=0), out=low)
    return low
