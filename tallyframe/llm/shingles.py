"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MOST_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype="u8") * _BASE)
    values[65:91] = values[97:123]  # A-Z count as a-z
    return values


_VALUE = _byte_values()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = mixed(np.arange(1, WORDS + 1, dtype="u8")) | np.uint64(1)
_powers: list[np.ndarray] = []


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _MOST_BYTES + 1)
        up, down = np.full(size, _BASE, "u8"), np.full(size, _UNBASE, "u8")
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word (run of bytes that are no ASCII white space)."""
    raw = np.frombuffer(data, "u1")
    solid = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    start, stop = edges[::2], edges[1::2]
    up, down = _powers_of(len(raw) + 1)
    total = np.zeros(len(raw) + 1, "u8")
    np.cumsum(_VALUE[raw] * up[:-1], out=total[1:])
    return mixed((total[stop] - total[start]) * down[start] + (stop - start).astype("u8")), start


def _batch(texts: list[bytes]) -> list[np.ndarray]:
    data = b"\n".join(texts)
    words, start = word_hashes(data)
    lengths = np.array([len(t) + 1 for t in texts])
    bounds = np.searchsorted(start, np.concatenate(([0], np.cumsum(lengths))))
    n = len(words)
    whole = np.zeros(max(0, n - WORDS + 1), "u8")
    for k in range(WORDS):
        whole += words[k:n - WORDS + 1 + k] * _PLACE[k] if len(whole) else np.uint64(0)
    whole = mixed(whole)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= WORDS:
            one = np.sort(whole[lo:hi - WORDS + 1])
            keep = np.concatenate(([True], one[1:] != one[:-1]))
            out.append(one if keep.all() else one[keep])
        elif hi > lo:  # fewer words: the whole sequence is the one shingle
            k = hi - lo
            out.append(mixed((words[lo:hi] * _PLACE[:k]).sum(keepdims=True) + _BASE * np.array([k], "u8")))
        else:
            out.append(np.empty(0, "u8"))
    return out


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's distinct shingles: ascending hashes; none for a null or a text without words.

    Whole texts, about a megabyte of them at a time (a longer text is alone).
    """
    some: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        if some and size + len(data) > _MOST_BYTES:
            yield from _batch(some)
            some, size = [], 0
        some.append(data)
        size += len(data) + 1
    if some:
        yield from _batch(some)
