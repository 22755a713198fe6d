"""Hashes of words and word shingles, many texts at a time.

Words are runs of bytes other than space and the control characters tab to carriage
return.  A word's hash is a polynomial over its bytes modulo 2^64, mixed with its length; a
shingle's hash combines its words' hashes.  Work arrays are bounded by CHUNK bytes of text.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_powers.get("up", ())):
        size = max(n, CHUNK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _words(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a piece that cuts no word."""
    space = _SPACE[data]
    edge = np.diff(space, prepend=True, append=True)
    at = np.flatnonzero(edge)
    starts, ends = at[::2], at[1::2]
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((_LOWER if lower else _SAME)[data] * up[:len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return starts, mix(h ^ ((ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93)))


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one
    more entry than texts)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        if end < len(data):  # cut after white space
            back = np.flatnonzero(_SPACE[data[at:end]])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        s, h = _words(data[at:end], lower)
        starts.append(s + at)
        hashes.append(h)
        at = end
    starts, hashes = np.concatenate(starts), np.concatenate(hashes)
    return hashes, np.searchsorted(starts, first)


def shingles(texts: list[bytes], n: int, lower: bool = False) -> list[np.ndarray]:
    """Per text the hashes of its n-word shingles in order (repeats included); a text of
    fewer words is one shingle, without words it has none."""
    w, first = words(texts, lower)
    m = _U(0xFF51AFD7ED558CCD)
    run = np.zeros(max(0, len(w) - n + 1), _U)
    for j in range(n):
        run = run * m + w[j:j + len(run)]
    run = mix(run)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(run[a:b - n + 1])
        elif b > a:
            one = np.zeros(1, _U)
            for x in w[a:b]:
                one = one * m + x
            out.append(mix(one ^ _U(b - a)))
        else:
            out.append(run[:0])
    return out


def sets(texts: list[bytes], n: int, lower: bool = False) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted."""
    return [np.unique(s) for s in shingles(texts, n, lower)]


def groups(texts, size: int = CHUNK):
    """Lists of consecutive texts (bytes) of about `size` bytes together."""
    own, total = [], 0
    for t in texts:
        own.append(t)
        total += len(t) + 1
        if total >= size:
            yield own
            own, total = [], 0
    if own:
        yield own
