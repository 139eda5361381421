"""Vectorised words of texts: 64-bit word hashes by numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. The hash of
a byte run is a polynomial over odd multiplier powers modulo 2**64, read from
one running sum, then mixed; texts are worked through in blocks of about
``BLOCK`` bytes, a longer text in pieces cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 19
_MULT = 0x5851F42D4C957F2D
_INV = pow(_MULT, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (shifts and odd multiplications), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = max(n, BLOCK + (1 << 16))
        for key, base in (("p", _MULT), ("i", _INV)):
            full = np.full(size, base, np.uint64)
            full[0] = 1
            _POW[key] = np.multiply.accumulate(full)
    return _POW["p"], _POW["i"]


class Words:
    """Words of one block of bytes: ``starts``, ``ends`` and substring hashes."""

    def __init__(self, data: np.ndarray):
        solid = np.zeros(len(data) + 2, np.int8)
        solid[1:-1] = ~_IS_SPACE[data]
        step = np.diff(solid)
        self.data = data
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        power, self._inv = _powers(len(data) + 1)
        self._run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self._run[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._run[ends] - self._run[starts]) * self._inv[starts])


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text in pieces of about BLOCK bytes, cut at white space."""
    at = 0
    while len(raw) - at > BLOCK:
        cut = at + BLOCK
        while cut < len(raw) and not _IS_SPACE[raw[cut]]:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def blocks(texts: list[bytes], ascii_lower: bool = True) -> Iterator[tuple[list[int], list[int], Words]]:
    """(text numbers, byte offset of each text's end, words) of each block.
    A text longer than a block comes in several blocks, one after another."""
    which: list[int] = []
    ends: list[int] = []
    held: list[bytes] = []
    size = 0

    def flush():
        data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        return which[:], ends[:], Words(_LOWER[data] if ascii_lower else data)

    for i, raw in enumerate(texts):
        for piece in _pieces(raw):
            which.append(i)
            held.append(piece)
            size += len(piece) + 1
            ends.append(size)
            if size >= BLOCK:
                yield flush()
                which, ends, held, size = [], [], [], 0
    if which:
        yield flush()


def word_hashes(texts: list[bytes], ascii_lower: bool = True) -> list[np.ndarray]:
    """Word hashes of each text, in order."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for which, ends, w in blocks(texts, ascii_lower):
        h = w.hashes(w.starts, w.ends)
        cuts = np.searchsorted(w.starts, np.array(ends))
        lo = 0
        for i, hi in zip(which, cuts):
            out[i].append(h[lo:hi])
            lo = hi
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; a shorter text counts as one
    shingle, an empty one has none."""
    if not len(words):
        return words
    k = min(n, len(words))
    acc = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD1342543DE82EF95) + words[j:len(words) - k + 1 + j]
    return np.unique(mix(acc ^ np.uint64(k)))
