"""Whole batches of texts as one array of code points, and hashes of all their windows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Characters worked on at once. It bounds memory (about 60 bytes a character); a longer text is worked on alone.
CHUNK_CHARS = 600_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def chunks(ids: list, texts: list, limit: int = CHUNK_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) in groups of at most `limit` characters; null texts count as empty."""
    a, b, size = [], [], 0
    for i, t in zip(ids, texts):
        t = t or ""
        if size and size + len(t) > limit:
            yield a, b
            a, b, size = [], [], 0
        a.append(i)
        b.append(t)
        size += len(t)
    if a:
        yield a, b


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and the offset at which each text begins (one more for the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_CHARS + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


class Rolling:
    """Hashes of the windows of any length of one text: a mixed polynomial hash (modulo 2^64), summed up once."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _power(_BASE, self.n), out=self.sums[1:])

    def windows(self, k: int) -> np.ndarray:
        """The hash of each window of k code points, by its first position."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        h = (self.sums[k:] - self.sums[: self.n + 1 - k]) * _power(_INVERSE, self.n - k + 1)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
        return h


def window_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """The hash of each window of k code points, by its first position."""
    return Rolling(points).windows(k)


def _sliding(values: np.ndarray, w: int, f, pad) -> np.ndarray:
    n = len(values)
    padded = np.concatenate([values, np.full(-n % w + w, pad, values.dtype)]).reshape(-1, w)
    before = f.accumulate(padded, axis=1).ravel()
    after = f.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(after[: n - w + 1], before[w - 1 : n])


def anchors(points: np.ndarray, starts: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: positions and hashes of the k-windows that are least among some w neighbours of the same text.

    Each span of k + w - 1 characters holds an anchor, and equal spans hold equal ones.
    """
    span = k + w - 1
    if len(points) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = window_hashes(points, k)
    least = _sliding(h, w, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(points))  # characters to the end of the own text
    least[left[: len(least)] < span] = 0
    reach = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    at = np.flatnonzero((_sliding(reach, w, np.maximum, np.uint64(0)) == h) & (h > 0))
    return at, h[at]


def int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))
