"""Words of whole batches of texts as numpy arrays: positions and 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sorrel.llm.common import slices

_MUL, _WIN, _WIN2 = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: White space as in [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i (mod 2 ** 64) for i < n."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        ones = [np.full(size, b, np.uint64) for b in (base, np.uint64(pow(int(base), -1, 1 << 64)))]
        for x in ones:
            x[0] = 1
        have = _POWERS[int(base)] = (np.cumprod(ones[0]), np.cumprod(ones[1]))
    return have[0][:n], have[1][:n]


def runs(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of values[start:end] for each pair, from prefix sums."""
    forth, back = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forth[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def word_hashes(texts: pa.LargeStringArray, breaks: np.ndarray = SPACE, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in a row, words in each text); words are runs of bytes that aren't in `breaks`."""
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    hashes, counts = [], []
    for a, b in slices(np.diff(offsets), most):
        data, off = whole[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        apart = np.ones(len(data) + 2, bool)
        apart[1:-1] = breaks[data]
        inside, edge = ~apart[1:-1], np.zeros(len(data) + 1, bool)
        edge[off] = True
        starts = np.flatnonzero(inside & (apart[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside & (apart[2:] | edge[1:])) + 1
        hashes.append(runs(data.astype(np.uint64) + np.uint64(1), _MUL, starts, ends))
        counts.append(np.diff(np.searchsorted(starts, off)))
    return np.concatenate(hashes), np.concatenate(counts)


def windows(words: np.ndarray, n: int, second: bool = False) -> np.ndarray:
    """Hash of each n consecutive words, by first word; one fewer than n at the end have none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    at = np.arange(len(words) - n + 1)
    return runs(mixed(words ^ _OTHER), _WIN2, at, at + n) if second else runs(words, _WIN, at, at + n)


def whole(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word of texts with `counts` words: the text, and whether n words starting there stay within it."""
    text = np.repeat(np.arange(len(counts)), counts)
    return text, np.arange(len(text)) + n <= np.cumsum(counts)[text]
