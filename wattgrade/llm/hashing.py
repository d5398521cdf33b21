"""Vectorised hashes of byte ranges and word shingles."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[tuple[np.ndarray, np.ndarray]] = []
# ASCII white space, as in word counts.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of each, kept for the next call."""
    if not _powers or len(_powers[0][0]) < n:
        up, down = np.full(n, BASE), np.full(n, INVERSE)
        up[0] = down[0] = 1
        _powers[:] = [(np.cumprod(up), np.cumprod(down))]
    return _powers[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """p with p[j] - p[i], times BASE**-i, depending on data[i:j] alone."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


def window_hashes(prefix: np.ndarray, length: int) -> np.ndarray:
    """``range_hashes`` of every ``length`` neighbouring bytes, from the first ones on."""
    out = prefix[length:] - prefix[: len(prefix) - length]
    out *= powers(len(prefix))[1][: len(out)]
    out += np.uint64(length)
    # The steps of ``mixed``, in place.
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, 64-bit hash) of every run of ``words`` words; of a shorter text, all its words together."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))  # starts and ends of words in turn
    start, end = edge[::2], edge[1::2]
    text = np.searchsorted(ends, start, side="right")
    word = range_hashes(prefix_hashes(data), start, end)
    found = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for i in range(words):
        found = found * BASE + word[i : i + len(found)]
    whole = text[: len(found)] == text[words - 1 :][: len(found)]
    owner, value = text[: len(found)][whole], mixed(found[whole])
    counts = np.bincount(text, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        extra = np.zeros(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for at, t in enumerate(short):
                for w in word[first[t] : first[t + 1]]:
                    extra[at] = extra[at] * BASE + w
        owner, value = np.concatenate([owner, short]), np.concatenate([value, mixed(extra + np.uint64(1))])
    return owner, value
