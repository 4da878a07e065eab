"""Vectorised words and word hashes for whole texts.

A batch of texts becomes one byte array. Words are runs of bytes other than
0x20 and 0x09-0x0D (all ASCII, so UTF-8 sequences stay whole). Every word gets a
64-bit hash from a prefix sum of ``table[byte] * BASE**position`` modulo 2**64,
so no Python code runs per word or per character. Hashes depend on the word's
bytes only: not on the batch, the process or the machine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Positions before the powers start again; words across a seam are hashed one by one.
_SPAN = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64); ``x`` is left as it is."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int) -> np.ndarray:
    out = np.full(_SPAN + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_FORWARD: np.ndarray | None = None
_BACKWARD: np.ndarray | None = None

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ngram_seed(n: int) -> int:
    return (0xA24BAED4963EE407 * (2 * n + 1)) & _MASK


@dataclass
class Words:
    """``hashes`` of all words in order; text ``i`` has words ``bounds[i]:bounds[i+1]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owners(self) -> np.ndarray:
        """Index of the text that each word stands in."""
        return np.repeat(np.arange(len(self)), self.counts)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _FORWARD, _BACKWARD
    if _FORWARD is None:
        _FORWARD, _BACKWARD = _powers(_BASE), _powers(_INVERSE)
    out = np.empty(len(starts), dtype=np.uint64)
    first, at = 0, 0
    while first < len(starts):
        at = int(starts[first])
        stop = min(at + _SPAN, len(data))
        last = int(np.searchsorted(ends, stop, side="right"))
        if last <= first:  # one word longer than the span
            out[first] = _hash_long(data[at : int(ends[first])])
            first += 1
            continue
        sums = np.zeros(stop - at + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data[at:stop]] * _FORWARD[: stop - at], out=sums[1:])
        s, e = starts[first:last] - at, ends[first:last] - at
        out[first:last] = (sums[e] - sums[s]) * _BACKWARD[s]
        first = last
    return mix(out ^ (ends - starts).astype(np.uint64))


def _hash_long(word: np.ndarray) -> int:
    """The same polynomial over a word longer than the span."""
    total, scale = 0, 1
    for i in range(0, len(word), _SPAN):
        part = word[i : i + _SPAN]
        total += scale * int((_TABLE[part] * _FORWARD[: len(part)]).sum(dtype=np.uint64))
        scale = scale * pow(_BASE, len(part), 1 << 64) & _MASK
    return total & _MASK


def words(texts: list[bytes | str | None], lower: bool = False) -> Words:
    """Words of every text; a null is an empty text, lower-casing takes A-Z only."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in raw), dtype=np.int64, count=len(raw))
    limits = np.concatenate([[0], np.cumsum(lengths)])
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    if lower:
        data = _LOWER[data]
    hashes = _hash_words(data, starts, ends) if len(starts) else np.empty(0, dtype=np.uint64)
    return Words(hashes, np.searchsorted(starts, limits), starts, ends, data)


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside each text, and the text each belongs to."""
    count = np.maximum(w.counts - n + 1, 0)
    owners = np.repeat(np.arange(len(w)), count)
    if not len(owners):
        return np.empty(0, dtype=np.uint64), owners
    begin = np.cumsum(count) - count
    at = np.arange(len(owners)) - begin[owners] + w.bounds[:-1][owners]
    return combine([w.hashes[at + i] for i in range(n)]), owners


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of hashes; the order of the parts counts."""
    n = len(parts)
    out = np.full(len(parts[0]), np.uint64(ngram_seed(n)))
    for p in parts:
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + p)
    return out


def by_owner(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` for each of ``n`` owners."""
    return np.bincount(owners, weights=values, minlength=n)
